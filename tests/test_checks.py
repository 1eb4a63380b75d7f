"""Every registered check against its DuckDB twin, on the smallest scale."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    from tools.compare import compare

    from checks import scenarios

    return compare(spark, SF, list(scenarios.CHECKS))


def test_all_keys_have_oracles():
    import __spark_entry__ as E
    from checks import scenarios

    assert set(scenarios.CHECKS) <= set(E.queries()) and set(scenarios.CHECKS) <= set(E.oracle_sql())


def _keys():
    from checks import scenarios

    return list(scenarios.CHECKS)


@pytest.mark.parametrize("key", _keys())
def test_check_matches_oracle(results, key):
    assert results[key]["ok"], results[key]


def test_entry(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert len(rows) == 16 and all(r.lines > 0 for r in rows)


def test_range_lines_reads_whole_files_and_appended_ranges(spark, tmp_path):
    """20 click and 10 view events: every line once, and the clicks of the last 40 % once more."""
    import __spark_entry__ as E
    from tools.compare import canon, duck

    rows = [(i, i, "view" if i % 3 == 2 else "click", f"props {i} " + "x" * 40) for i in range(30)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string").coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")
    got = E.queries()["range_lines"](spark, str(tmp_path)).toPandas()
    lines = [f"{i}|{i}|{t}|{p}" for i, _, t, p in rows]
    assert sorted(got["value"]) == sorted(lines + [x for x, r in zip(lines, rows) if r[2] == "click" and r[0] >= 18])
    con = duck("/nowhere")
    con.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert canon(got) == canon(con.execute(E.oracle_sql()["range_lines"]).df())
