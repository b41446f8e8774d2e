"""Incremental loads: each file once, new files on the next run."""

import os

from fundflow.sources.loader import read_quarantine, read_table
from fundflow.streaming.filings import start_filing_load


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_available_now_runs_pick_up_only_new_files(spark, scratch):
    root, wh, ck = f"{scratch}/extracted", f"{scratch}/wh", f"{scratch}/ck"
    _write(f"{root}/2022/ccl/a.txt", ["H1|2022|2022|C1|H|P|L1", "H2|2022|2022|C2|H|P|L2",
                                      "BAD|ROW"])
    q = start_filing_load(spark, root, "ccl", wh, ck)
    q.awaitTermination(120)
    assert read_table(spark, wh, "candidate_committee_linkage").count() == 2
    assert [bytes(r.line) for r in read_quarantine(spark, wh, "candidate_committee_linkage").collect()] == [b"BAD|ROW"]
    _write(f"{root}/2024/ccl/b.txt", ["H3|2024|2024|C3|H|P|L3"])
    q = start_filing_load(spark, root, "ccl", wh, ck)
    q.awaitTermination(120)
    rows = read_table(spark, wh, "candidate_committee_linkage").collect()
    assert sorted(r.cand_id for r in rows) == ["H1", "H2", "H3"]
    assert {(r.cycle_year, r.source_file) for r in rows} == {(2022, "a.txt"), (2024, "b.txt")}
    # a file issued again under its old path is replaced when the next batch comes
    _write(f"{root}/2022/ccl/a.txt", ["H4|2022|2022|C1|H|P|L1"])
    _write(f"{root}/2024/ccl/c.txt", ["H5|2024|2024|C3|H|P|L3"])
    start_filing_load(spark, root, "ccl", wh, ck).awaitTermination(120)
    rows = read_table(spark, wh, "candidate_committee_linkage").collect()
    assert sorted(r.cand_id for r in rows) == ["H3", "H4", "H5"]
