
import pytest

import __spark_entry__ as E

NAMES = ["global_rank", "conditional_rank", "surrogate_key", "dedup_rows", "header_fill", "boxplot_stats",
         "dim_round", "silver_race", "fact_race", "lookup_fk_multi", "rank_join_back", "header_attach"]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_at_any_partition_count(spark, sf, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            df = E.queries()[name](spark, sf)
            results.append(sorted(map(tuple, df.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]
