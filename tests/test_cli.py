import json

from podium.__main__ import main
from podium.session import scratch_path
from podium.sources.tables import load
from tests.fixtures import CASES


def test_cli_run_then_score(spark, tmp_path, capsys):
    sheets = tmp_path / "sheets"
    sheets.mkdir()
    heats = [line for lay, line, _ in CASES if lay == "heats"]
    (sheets / "1st round male.txt").write_text(
        "\n".join(["Stade de France Athlétisme", "Men's 100m Round 1", "SAT 3 AUG 2024"] + heats) + "\n",
        encoding="utf-8")
    codes = tmp_path / "codes.txt"
    codes.write_text("USA\nFRA\nMRI\nMAR\nESP\n", encoding="utf-8")
    out = scratch_path(spark, "cli")
    assert main(["run", "--sheets", str(sheets), "--dictionary", str(codes), "--out", out,
                 "--load-time", "2024-08-05 00:00:00"]) == 0
    paths = json.loads(capsys.readouterr().out)
    assert load(spark, paths["gold_fact_race"]).count() == len(heats)
    assert main(["score", "--fact", paths["gold_fact_race"], "--out", scratch_path(spark, "cli-ml")]) == 0
    scored = json.loads(capsys.readouterr().out)
    assert load(spark, scored["top"]).count() == 3
