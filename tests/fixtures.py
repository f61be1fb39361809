"""Invented result-sheet lines (FIXTURES.md) and their expected records (compat)."""

DICTIONARY = ["USA", "FRA", "MRI", "MAR", "ESP", "JAM", "LCA"]
N = None
FIELDS = ("rank", "bib", "name", "code", "heat", "lane", "pos", "time", "ms", "wind", "result", "info")

CASES = [
    ("heats", "1 1501 SAMPLE  Ada USA 3 5 2 10.04 (.032) +0.3 Q SB",
     ("1", "1501", "SAMPLE Ada", "USA", "3", "5", "2", "10.04", ".032", "+0.3", "Q", "SB")),
    ("heats", "12 1502 DOE Bo FRA 1 4 6 10.31 -0.2 q PB",
     ("12", "1502", "DOE Bo", "FRA", "1", "4", "6", "10.31", N, "-0.2", "q", "PB")),
    ("heats", "1206 LOUIS Kim MRI 5 8 DNS",
     ("1206", "LOUIS", "Kim", "MRI", "5", "8", "DNS", N, N, N, N, N)),
    ("heats", "3 1503 MAR Lee ESP 1 2 3 10.50 +0.1",
     ("3", "1503", "", "MAR", "Lee", "ESP", "1", "2", N, "3", N, N)),
    ("final_a", "1 1433 BETA Di USA 7 9.79 (.784) 0.178 PB",
     ("1", "1433", "BETA Di", "USA", N, "7", N, "9.79", ".784", "+1.0", "Q", "PB")),
    ("final_a", "2 1434 ZETA Al JAM 4 9.79 (.789) 0.176",
     ("2", "1434", "ZETA Al", "JAM", N, "4", N, "9.79", ".789", "+1.0", N, N)),
    ("final_b", "1 2001 ALFA Cy LCA 10 JAN 2001 0.144 6 1 +0.4 10.72",
     ("1", "2001", "ALFA Cy", "LCA", N, "6", "1", "10.72", N, "+0.4", "Q", "NR")),
    ("final_b", "2 2002 GAMMA El USA 3 MAR 2000 0.150 7 2 +0.4 10.87",
     ("2", "2002", "GAMMA El", "USA", N, "7", "2", "10.87", N, "+0.4", N, N)),
]
REJECTED = "7 1504 NOBODY Jo XXX 1 2"
LEADING_SPACE = " 8 1505 LEAD Sp USA 1 1 1 10.1 +0.1 Q"

HEADER_FILES = {
    "a": ["Stade de France Athlétisme", "Women's 100m Round 1", "SAT 3 AUG 2024", "Final"],
    "b": ["Men's 100m Final", "Semi-final"],
}
HEADER_EXPECTED = {
    "a": ("Women's 100m", "Round 1", "SAT 3 AUG 2024", "Stade de France Athlétisme"),
    "b": ("Men's 100m", "Semi-final", None, None),
}
