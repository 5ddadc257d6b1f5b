"""Property test: the native filename parser (P8) against the independent
DuckDB form of the same ordered rules (the oracle SQL of ``filename_label``),
on generated file names."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from vocalis.operators import labels as LB
from vocalis.plans import queries as Q
from vocalis.plans import views as V

TOKENS = ["03", "01", "05", "08", "09", "oaf", "back", "angry", "ps", "sad", "ANG", "Fea", "dc", "sa01",
          "su13", "a", "n07", "x2", "XX", "calm", ""]
names = st.builds(
    lambda parts, seps, ext: "".join(p + s for p, s in zip(parts, seps)) + ext,
    st.lists(st.sampled_from(TOKENS), min_size=1, max_size=7),
    st.lists(st.sampled_from(["-", "_", ""]), min_size=7, max_size=7),
    st.sampled_from([".wav", ".WAV", ""]))
dirs = st.sampled_from(["", "Dataset/Tess/", "a/b-c_d/"])


def duck_labels(paths):
    values = ", ".join(f"({i}, '{p}')" for i, p in enumerate(paths))
    sql = Q._FN_SQL.replace(V.CLIP_PATHS_SQL,
                            f"WITH clip_paths AS (SELECT * FROM (VALUES {values}) t(event_id, path))")
    return {int(r[0]): r[2] for r in duckdb.sql(sql).fetchall()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(dirs, names), min_size=20, max_size=40))
def test_filename_parser_matches_sql_rules(spark, batch):
    paths = [d + n for d, n in batch]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "id long, path string")
    got = {r["id"]: r["fn_label"] for r in LB.with_filename_label(df).collect()}
    assert got == duck_labels(paths)
