"""Filing files -> raw tables: round trip, malformed rows, reloads, manifest."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundflow.sources import delimited, loader
from fundflow.sources.layouts import FILE_TYPES
from fundflow.sources.lens import lens_tables


def _write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_roundtrip_of_lens_tables(spark, scratch):
    raw = lens_tables(spark, SF_SMALL)
    # line breaks inside a field can't be told from row ends in this format; the lens has none
    for ftype in ("cm", "ccl", "cn"):
        table, cols = FILE_TYPES[ftype]
        src = raw[table].filter(F.col("cycle_year") == 2000) if ftype == "cm" else raw[table]
        out = f"{scratch}/export/{ftype}"
        delimited.write_filing(src, out, cols)
        back = delimited.read_filing(spark, f"{out}/*.csv", ftype, cycle_year=2000)
        # empty unquoted fields read back as NULL, as in the bulk loader
        norm = [F.when(F.col(c) == "", None).otherwise(F.col(c)).alias(c) for c in cols]
        assert sorted(map(tuple, src.select(*norm).collect())) == \
            sorted(map(tuple, back.select(*cols).collect()))


def test_malformed_rows_dropped_and_quotes_kept(spark, scratch):
    path = f"{scratch}/2024/ccl/ccl.txt"
    _write_lines(path, ["H1|2024|2024|C1|H|P|L1",
                        "H2|2024|2024|C2|H|P",                 # 6 fields
                        "H3|2024|2024|C3|H|P|L3|extra",        # 8 fields
                        'H4|2024|2024|"C4|H|P|L4'])            # stray quote kept
    df = delimited.read_filing(spark, path, "ccl")
    rows = df.orderBy("cand_id").collect()
    assert [r.cand_id for r in rows] == ["H1", "H4"]
    assert rows[1].cmte_id == '"C4'
    assert df.count() == 2
    assert {r.cycle_year for r in rows} == {2024} and {r.source_file for r in rows} == {"ccl.txt"}


LINK = "candidate_committee_linkage"


def _load(spark, root, wh, cycles=(2022, 2024)):
    return sorted(map(tuple, loader.load_raw(spark, root, wh, list(cycles), ["ccl"]).collect()))


def test_load_reads_every_file_and_counts_rejected_lines(spark, scratch):
    root, wh = f"{scratch}/extracted", f"{scratch}/wh"
    _write_lines(f"{root}/2022/ccl/b.txt", ["H9|2022|2022|C9|H|P|L9", "", "too|few"])
    _write_lines(f"{root}/2022/ccl/a.txt", ["H1|2022|2022|C1|H|P|L1", "H2|2022|2022|C2|H|P|L2"])
    _write_lines(f"{root}/2024/ccl/x.txt", ["H3|2024|2024|C3|H|P|L3"])
    expected = [(LINK, 2022, "a.txt", 2, 0), (LINK, 2022, "b.txt", 1, 1), (LINK, 2024, "x.txt", 1, 0)]
    assert _load(spark, root, wh) == expected
    assert _load(spark, root, wh) == expected          # loading twice equals loading once
    rows = loader.read_table(spark, wh, LINK)
    assert rows.count() == 4 and {r.source_file for r in rows.collect()} == {"a.txt", "b.txt", "x.txt"}
    assert loader.read_table(spark, wh, "opensecrets_committees").count() == 0


def test_reload_equals_a_fresh_load(spark, scratch):
    root, wh = f"{scratch}/extracted", f"{scratch}/wh"
    for name in ("a.txt", "b.txt", "c c=1.txt", "kept.txt"):
        _write_lines(f"{root}/2022/ccl/{name}", ["H1|2022|2022|C1|H|P|L1", "H2|2022|2022|C2|H|P|L2"])
    _load(spark, root, wh, [2022])
    open(f"{root}/2022/ccl/a.txt", "w").close()                                   # now empty
    _write_lines(f"{root}/2022/ccl/b.txt", ["all", "malformed|lines"])
    _write_lines(f"{root}/2022/ccl/c c=1.txt", ["H5|2022|2022|C5|H|P|L5"])        # shorter
    counts = _load(spark, root, wh, [2022])
    assert counts == [(LINK, 2022, "a.txt", 0, 0), (LINK, 2022, "b.txt", 0, 2),
                      (LINK, 2022, "c c=1.txt", 1, 0), (LINK, 2022, "kept.txt", 2, 0)]
    fresh = f"{scratch}/fresh"
    assert _load(spark, root, fresh, [2022]) == counts
    both = [sorted(map(tuple, loader.read_table(spark, w, LINK).collect())) for w in (wh, fresh)]
    assert both[0] == both[1] and len(both[0]) == 3


def test_manifest_status(spark, scratch):
    root = f"{scratch}/raw"
    for year in (2022, 2024):
        _write_lines(f"{root}/{year}/cn/a.txt", ["x"])
        _write_lines(f"{root}/{year}/cn/b.txt", ["yy"])
    open(f"{root}/2024/cn/empty.txt", "w").close()
    manifest = spark.createDataFrame(
        [(2022, "cn", "a.txt", 2), (2022, "cn", "a.txt", 2), (2022, "cn", "b.txt", 1),
         (2024, "cn", "b.txt", 3), (2024, "cn", "b.txt", 9), (2024, "cm", "a.txt", 2),
         (2024, "cn", "empty.txt", 0)],
        "cycle_year int, file_type string, file_name string, file_size long")
    status = delimited.file_manifest_status(spark, f"{root}/*/cn/*.txt", manifest)
    got = sorted((r.cycle_year, r.file_name, r.status) for r in status.collect())
    assert got == [(2022, "a.txt", "skipped"), (2022, "b.txt", "changed"), (2024, "a.txt", "new"),
                   (2024, "b.txt", "skipped"), (2024, "empty.txt", "changed")]
    counts = {r.status: r.files for r in delimited.manifest_counts(status).collect()}
    assert counts == {"skipped": 2, "changed": 2, "new": 1}


def test_missing_cycle_folder_skipped_and_cycle_domain(spark, scratch):
    import pytest
    from fundflow.sources.layouts import check_cycles
    root = f"{scratch}/extracted"
    _write_lines(f"{root}/2022/ccl/a.txt", ["H1|2022|2022|C1|H|P|L1"])
    found = delimited.discover_inputs(spark, root, [2020, 2022], ["ccl", "cn"])
    assert list(found) == ["ccl"] and found["ccl"][0][2].endswith("/2022/ccl/a.txt")
    assert check_cycles([2024, 1980, 2024]) == [1980, 2024]
    for bad in ([2023], [1978], [2026]):
        with pytest.raises(ValueError):
            check_cycles(bad)
