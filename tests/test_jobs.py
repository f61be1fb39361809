import pytest
from pyspark.sql import functions as F

from podium.plans import jobs
from podium.session import scratch_path
from podium.sources.files import read_text_files
from podium.sources.tables import load
from tests.fixtures import CASES, DICTIONARY, REJECTED

HEADER_M = ["Stade de France Athlétisme", "Men's 100m Round 1", "SAT 3 AUG 2024"]
HEADER_W = ["Stade de France Athlétisme", "Women's 100m Final", "SUN 4 AUG 2024"]
FINAL_M_HEAD = ["Stade de France Athlétisme", "Men's 100m Final", "SUN 4 AUG 2024"]


def _write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture(scope="module")
def sheets(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sheets")
    heats = [line for lay, line, _ in CASES if lay == "heats"]
    _write(d, "1st round male.txt", HEADER_M + ["Rank Bib Name NOC Heat Lane Pos Time Wind"] + heats + [REJECTED])
    _write(d, "final male.txt", FINAL_M_HEAD + [line for lay, line, _ in CASES if lay == "final_a"])
    _write(d, "final female.txt", HEADER_W + [line for lay, line, _ in CASES if lay == "final_b"])
    return read_text_files(spark, str(d))


def test_sheets_to_bronze(spark, sheets):
    bronze, rejects = jobs.sheets_to_bronze(sheets, DICTIONARY)
    rows = bronze.collect()
    assert len(rows) == len(CASES)
    assert [r.line for r in rejects.collect()] == [REJECTED]
    by_bib = {r["Athlete Bib"]: r for r in rows}
    assert by_bib["1501"]["Event Type"] == "Men's 100m" and by_bib["1501"]["Round"] == "Round 1"
    assert by_bib["1433"]["Wind"] == "+1.0" and by_bib["1433"]["Milliseconds"] == ".784"
    assert by_bib["2001"]["Additional Info"] == "NR" and by_bib["2001"]["Round"] == "Final"
    assert by_bib["2001"]["Date"] == "SUN 4 AUG 2024"


def test_medallion_job_strict_and_rerun(spark, sheets):
    bronze, _ = jobs.sheets_to_bronze(sheets, DICTIONARY, compat=False)
    out = scratch_path(spark, "job")
    p = jobs.medallion_job(spark, bronze, out, load_time="2024-08-05 00:00:00")
    first = {k: sorted(map(tuple, load(spark, v).collect())) for k, v in p.items() if k != "bronze"}
    jobs.medallion_job(spark, bronze, out, load_time="2024-08-05 00:00:00")
    again = {k: sorted(map(tuple, load(spark, v).collect())) for k, v in p.items() if k != "bronze"}
    assert first == again
    athletes = {r.id: r for r in load(spark, p["silver_athlete"]).collect()}
    # LOUIS is patched to 1206 and prefixed once; the four missing athletes are there once
    assert athletes[1206].name == "LOUIS Kim"
    assert {514, 452, 690, 1042} <= set(athletes)
    fact = load(spark, p["gold_fact_race"])
    assert fact.count() == len(CASES)
    r = fact.filter(F.col("NK_athlete") == 1206).first()
    assert r.position == 0 and r.time == "0.000"  # reset row (quirk 14 / 17)
    q = fact.filter(F.col("NK_athlete") == 1501).first()
    assert (q.qualified, q.qualification_type, q.record_type, q.time) == (True, "Place", "Season Best", "10.04.032")
    dates = {r.date for r in load(spark, p["silver_round"]).collect()}
    assert dates == {"03/08/24", "04/08/24"}
    locs = {r.location for r in load(spark, p["silver_round"]).collect()}
    assert locs == {"Stade de France"}
    # final ranks: the men's final has null positions, ranked Q first then time
    fm = {r.NK_athlete: r.position for r in fact.filter(F.col("NK_athlete").isin(1433, 1434)).collect()}
    assert fm == {1433: 1, 1434: 2}


def test_medallion_job_compat(spark, sheets):
    bronze, _ = jobs.sheets_to_bronze(sheets, DICTIONARY, compat=True)
    out = scratch_path(spark, "job-compat")
    p = jobs.medallion_job(spark, bronze, out, compat=True)
    assert load(spark, p["gold_fact_race"]).count() >= len(CASES)


def test_finalist_scoring(spark, sheets):
    bronze, _ = jobs.sheets_to_bronze(sheets, DICTIONARY, compat=False)
    p = jobs.medallion_job(spark, bronze, scratch_path(spark, "job-ml"))
    out = jobs.finalist_job(spark, p["gold_fact_race"], scratch_path(spark, "ml"), compat=False, num_trees=5,
                            rounds_path=p["gold_dim_round"])
    top = load(spark, out["top"]).collect()
    # the finals are left out by name: only athletes of the heats are scored
    assert {r.NK_athlete for r in top} <= {1501, 1502, 1206, 1503}
    assert len(top) == 3 and all(0.0 <= r.win_probability <= 1.0 for r in top)
    assert load(spark, out["box"]).count() > 0 and load(spark, out["counts"]).count() > 0
    assert sum(r.n for r in load(spark, out["metrics"]).collect()) >= 3


def test_sheets_to_gold_through_csv(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sheets2")
    heats = [line for lay, line, _ in CASES if lay == "heats"]
    _write(d, "1st round male.txt", HEADER_M + heats + [REJECTED])
    _write(d, "final female.txt", HEADER_W + [line for lay, line, _ in CASES if lay == "final_b"])
    out = scratch_path(spark, "pipe")
    p = jobs.sheets_to_gold(spark, str(d), DICTIONARY, out, load_time="2024-08-05 00:00:00")
    assert load(spark, p["gold_fact_race"]).count() == len(heats) + 2
    assert [r.line for r in load(spark, p["rejects"]).collect()] == [REJECTED]
    with pytest.raises(Exception):
        load(spark, p["bronze"]).count()  # retired after gold is written


def test_split_text_files_give_the_same_bronze(spark, tmp_path_factory):
    from podium.sources.files import read_text_lines
    d = tmp_path_factory.mktemp("sheets3")
    heats = [line for lay, line, _ in CASES if lay == "heats"]
    _write(d, "1st round male.txt", HEADER_M + heats * 20)
    whole, _ = jobs.sheets_to_bronze(read_text_files(spark, str(d)), DICTIONARY, header_scope="file")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        lines = read_text_lines(spark, str(d))
        assert lines.rdd.getNumPartitions() > 3
        split, _ = jobs.lines_to_bronze(lines, DICTIONARY, header_scope="file")
        assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_gold_fact_is_partitioned_by_round_and_pruned(spark, sheets):
    bronze, _ = jobs.sheets_to_bronze(sheets, DICTIONARY, compat=False)
    p = jobs.medallion_job(spark, bronze, scratch_path(spark, "job-parts"))
    fact = load(spark, p["gold_fact_race"])
    kept = fact.filter((F.col("NK_round") != 2) & (F.col("NK_round") != 3))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "NK_round" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert fact.count() == len(CASES)


def test_rounds_are_excluded_by_name_and_pruned(spark, sheets):
    from podium.operators import shape
    bronze, _ = jobs.sheets_to_bronze(sheets, DICTIONARY, compat=False)
    p = jobs.medallion_job(spark, bronze, scratch_path(spark, "job-names"))
    fact, rounds = load(spark, p["gold_fact_race"]), load(spark, p["gold_dim_round"])
    kept = shape.keep_by_dimension(fact, "NK_round", rounds, "id", ~F.col("round").isin("Semi-final", "Final"))
    finals = [r.id for r in rounds.collect() if r["round"] == "Final"]
    assert len(finals) == 2
    assert kept.count() == fact.filter(~F.col("NK_round").isin(finals)).count() < fact.count()
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        jobs.finalist_scoring(fact, compat=False)


def test_failed_run_leaves_the_published_tables(spark, sheets, monkeypatch):
    """A run that dies between two tables: every reader still sees the old set; the next run replaces it."""
    bronze, _ = jobs.sheets_to_bronze(sheets, DICTIONARY, compat=False)
    out = scratch_path(spark, "job-fail")
    p = jobs.medallion_job(spark, bronze, out, load_time="2024-08-05 00:00:00")
    names = [n for n in p if n != "bronze"]
    before = {n: sorted(map(str, load(spark, p[n]).collect())) for n in names}
    with monkeypatch.context() as m:
        m.setattr(jobs, "gold_fact_race", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.medallion_job(spark, bronze.limit(2), out, load_time="2025-01-01 00:00:00")
    assert {n: sorted(map(str, load(spark, p[n]).collect())) for n in names} == before
    jobs.medallion_job(spark, bronze, out, load_time="2025-01-01 00:00:00")
    assert {r.insert_date.year for r in load(spark, p["gold_fact_race"]).collect()} == {2025}


def test_two_day_round_and_spellings(spark):
    """The race finds its round by the whole key, and spellings of one key are one round."""
    from podium.sources.csv import BRONZE_SCHEMA
    cols = BRONZE_SCHEMA.fieldNames()
    base = dict(zip(cols, [None] * len(cols))) | {"Event Type": "Men's 100m", "Round": "Round 1", "Rank": "1", "Name": "DOE Bo",
                                                  "NOC Code": "FRA", "Heat": "1", "Lane": "2", "Pos": "3", "Time": "10.1"}
    where = "Stade de France"
    rows = [base | {"Athlete Bib": str(i), "Date": day, "Location": loc} for i, (day, loc) in enumerate([
        ("SAT 3 AUG 2024", where + " Athlétisme"), ("SAT 03 AUG 2024", where), ("SUN 4 AUG 2024", where), (None, where)])]
    bronze = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], BRONZE_SCHEMA)
    rounds = jobs.silver_round(bronze)
    assert sorted((r.date or "", r.location) for r in rounds.collect()) == \
        [("", where), ("03/08/24", where), ("04/08/24", where)]
    race = jobs.silver_race(bronze, jobs.silver_athlete(bronze), rounds)
    by_date = {r.date: r.id for r in rounds.collect()}
    got = {r.FK_athlete_id: r.FK_round_id for r in race.collect()}
    assert got == {0: by_date["03/08/24"], 1: by_date["03/08/24"], 2: by_date["04/08/24"], 3: by_date[None]}


def test_round_ids_survive_a_new_round(spark, sheets, tmp_path):
    bronze, _ = jobs.sheets_to_bronze(sheets, DICTIONARY, compat=False)
    path = str(tmp_path / "rounds")
    first = bronze.filter("Round = 'Final'")
    one = {(r["round"], r.event): r.id for r in jobs.silver_round(first, registry=path).collect()}
    both = {(r["round"], r.event): r.id for r in jobs.silver_round(bronze, registry=path).collect()}
    assert both == {**one, ("Round 1", "Men's"): 3}


def test_sheet_counts(spark, sheets):
    counts = {}
    jobs.sheets_to_bronze(sheets, DICTIONARY, counts=counts)
    assert counts == {"records": len(CASES), "rejects": 1}


def test_headers_are_put_in_form_once(spark, monkeypatch):
    """The round of a race is looked up once a header, not once a row; null and empty texts are two headers."""
    from podium.operators import conform
    from podium.sources.csv import BRONZE_SCHEMA
    cols = BRONZE_SCHEMA.fieldNames()
    rows = [dict(zip(cols, [None] * len(cols))) | {"Event Type": "Women's 100m", "Round": rnd, "Athlete Bib": str(i), "Rank": str(i)}
            for i, rnd in enumerate(["Round 1", "Round 1 ", None, ""] * 5)]
    bronze = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], BRONZE_SCHEMA)
    rounds = jobs.silver_round(bronze.filter("Round IS NOT NULL AND Round <> ''"))
    seen, lookup = [], conform.lookup_fk

    def spy(fact, dim, *args, **kwargs):
        if "round" in dim.columns:
            seen.append(fact.count())
        return lookup(fact, dim, *args, **kwargs)

    monkeypatch.setattr(conform, "lookup_fk", spy)
    race = jobs.silver_race(bronze, jobs.silver_athlete(bronze), rounds)
    one = rounds.first()["id"]
    assert {int(r["rank"]): r.FK_round_id for r in race.collect()} == {i: one if i % 4 < 2 else None for i in range(20)}
    assert seen == [4]


def test_no_stage_is_left_to_the_interpreter(spark, sheets):
    """Methods that the JVM would not compile are not generated."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    jobs.sheets_to_bronze(sheets, DICTIONARY)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
