"""Fixed values.

These must equal the reference's for equal results.  Each is stated once,
as text, in the reference's own order; the modules import them from here.
"""

# Landing sheet columns, all text.
BRONZE_COLUMNS = ("Event Type", "Round", "Date", "Location", "Rank", "Athlete Bib", "Name",
                  "NOC Code", "Heat", "Lane", "Pos", "Time", "Milliseconds", "Wind", "Result",
                  "Additional Info")

# Codes searched after the country code of a result line.
SPECIAL_CODES = ("=SB", "DNS", "DQ", "Fn", "PB", "SB", "TR")

# Header patterns (event, round, date, location marker) and the header defaults.
EVENT_PATTERN = r"(Men's|Women's)\s100m"
ROUND_PATTERN = r"(Round \d+|Semi-final|Final|Preliminary Round)"
DATE_PATTERN = r"\b[A-Z]{3}\s\d{1,2}\s[A-Z]{3}\s\d{4}\b"
LOCATION_MARK = "Stade de France"
HEADER_DEFAULTS = {"event_type": "Unknown Event", "round": "Preliminary Round",
                   "date": "Unknown Date", "location": "Unknown Location"}

# Result, disqualification and record codes with their kinds.
QUALIFICATION = {"Q": "Place", "q": "Time"}
DISQUALIFICATION = {"DQ": "Rule", "DNS": "Did Not Started"}
RECORD = {"SB": "Season Best", "PB": "Personal Best", "=SB": "Equal Season Best",
          "NR": "National Record"}

# Corrections of the athlete and race data.
SURNAME_IDS = {"LOUIS": "1206", "SABINO": "1042", "AZU": "690", "MULAMBA": "514", "BROWN": "452"}
NULL_FK_FIXES = [("5", "5", 514), ("2", "3", 1042), ("1", "4", 690), ("8", "7", 452), ("8", "8", 514),
                 ("5", "8", 1206), ("2", "5", 2055)]
RESET_IDS = [514, 1206, 2055, 1042, 690, 452]
MISSING_ATHLETES = [(514, "MULAMBA Dominique Lasconi", "COD", "Male"), (452, "BROWN Aaron", "CAN", "Male"),
                    (690, "AZU Jeremiah", "GBR", "Male"), (1042, "SABINO Steven", "MOZ", "Male")]

# Event texts and their parts, the end of a location, status texts of a position.
MENS_100M = "Men's 100m"
WOMENS_100M = "Women's 100m"
EVENT_PARTS = [("%Men's%", "Men's"), ("%Women's%", "Women's")]
EVENT_TYPE_PARTS = [("%100m", "100m")]
LOCATION_END = " Athlétisme"
STATUS_EXACT = {"DNS": "DNS", "DQ": "DQ"}
STATUS_PATTERNS = {"F1": "DQ"}

# Scoring: excluded round ids and the rounds they stand for, rank limit, forest size and seed, test share.
EXCLUDED_ROUND_IDS = [2, 3]
EXCLUDED_ROUNDS = ["Semi-final", "Final"]
RANK_LIMIT = 452
FOREST_TREES = 100
FOREST_SEED = 42
