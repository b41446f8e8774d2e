"""Manifest-driven, atomic loads: what is read, what is seen, and what is set aside."""

import os

import pytest

from fundflow.sources import loader

LINK = "candidate_committee_linkage"
YEARS = [2022, 2024]


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(b"".join((x if isinstance(x, bytes) else x.encode()) + b"\n" for x in lines))


def _line(i, name="C1"):
    return f"H{i}|2022|2022|{name}|H|P|L{i}"


def _load(spark, root, wh, **more):
    rows = loader.load_filings(spark, root, wh, YEARS, ["ccl"], **more).collect()
    return {(r.cycle_year, r.file_name): (r.status, r.rows, r.rejected) for r in rows}


def _ids(spark, wh):
    return sorted(r.cand_id for r in loader.read_table(spark, wh, LINK).collect())


def test_second_run_loads_nothing_and_a_changed_file_replaces_its_rows(spark, scratch):
    root, wh = f"{scratch}/x", f"{scratch}/wh"
    _write(f"{root}/2022/ccl/a.txt", [_line(1), _line(2), "bad|line"])
    _write(f"{root}/2024/ccl/a.txt", [_line(3)])
    open(f"{root}/2024/ccl/empty.txt", "w").close()
    assert _load(spark, root, wh) == {(2022, "a.txt"): ("new", 2, 1), (2024, "a.txt"): ("new", 1, 0),
                                      (2024, "empty.txt"): ("new", 0, 0)}
    first = loader.commits(spark, wh, LINK)
    _write(f"{root}/2024/ccl/empty.txt", [])
    assert _load(spark, root, wh)[2022, "a.txt"] == ("skipped", 2, 1)
    _write(f"{root}/2024/ccl/empty.txt", [_line(8)])
    before = len(loader.commits(spark, wh, LINK))
    _load(spark, root, wh)
    assert len(loader.commits(spark, wh, LINK)) == before + 1 > len(first)
    again = len(loader.commits(spark, wh, LINK))
    assert {s for s, _, _ in _load(spark, root, wh).values()} == {"skipped"}
    assert len(loader.commits(spark, wh, LINK)) == again                   # nothing was loaded
    _write(f"{root}/2022/ccl/a.txt", [_line(7)])
    assert _load(spark, root, wh)[2022, "a.txt"] == ("changed", 1, 0)
    assert _ids(spark, wh) == ["H3", "H7", "H8"]
    fresh = f"{scratch}/fresh"
    _load(spark, root, fresh)
    assert _ids(spark, fresh) == _ids(spark, wh)
    assert loader.manifest(spark, wh, LINK).count() == 3
    assert loader.manifest(spark, wh, LINK, history=True).count() > 3


@pytest.mark.parametrize("fails", ["_written_counts", "_commit"])
def test_a_load_that_fails_changes_nothing_for_readers_and_is_repeated(spark, scratch, monkeypatch, fails):
    root, wh = f"{scratch}/x", f"{scratch}/wh"
    _write(f"{root}/2022/ccl/a.txt", [_line(1)])
    _load(spark, root, wh)
    _write(f"{root}/2022/ccl/a.txt", [_line(2), _line(3)])

    def broken(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(loader, fails, broken)
        with pytest.raises(RuntimeError):
            _load(spark, root, wh)
        assert _ids(spark, wh) == ["H1"]                                   # old rows, whole
    assert _load(spark, root, wh) == {(2022, "a.txt"): ("changed", 2, 0)}
    assert _ids(spark, wh) == ["H2", "H3"]


def test_a_reader_keeps_its_snapshot_while_a_load_commits(spark, scratch):
    root, wh = f"{scratch}/x", f"{scratch}/wh"
    _write(f"{root}/2022/ccl/a.txt", [_line(1)])
    _load(spark, root, wh)
    snapshot = loader.read_table(spark, wh, LINK)
    _write(f"{root}/2022/ccl/a.txt", [_line(2), _line(3)])
    _load(spark, root, wh)
    assert [r.cand_id for r in snapshot.collect()] == ["H1"] and _ids(spark, wh) == ["H2", "H3"]


def test_a_named_load_is_loaded_once_and_two_loaders_get_two_numbers(spark, scratch):
    root, wh = f"{scratch}/x", f"{scratch}/wh"
    _write(f"{root}/2022/ccl/a.txt", [_line(1)])
    files = loader.discovered(spark, root, YEARS, ["ccl"])
    for _ in range(2):
        loader.load_type(spark, files, "ccl", wh, load="batch-7").collect()
    assert [name for _, name in loader.commits(spark, wh, LINK)] == ["batch-7"]
    loader._commit(spark, wh, LINK, "batch-7x")
    assert [n for n, _ in loader.commits(spark, wh, LINK)] == [1, 2]


def test_undecodable_lines_are_set_aside_or_read_by_a_charset(spark, scratch):
    root = f"{scratch}/x"
    _write(f"{root}/2022/ccl/a.txt", [_line(1), b"H2|2022|2022|C\xe9|H|P|L2", b"H3|2022|2022|C\xc3\xa9|H|P|L3", b"\xff"])
    wh = f"{scratch}/utf8"
    assert _load(spark, root, wh) == {(2022, "a.txt"): ("new", 2, 2)}
    aside = loader.read_quarantine(spark, wh, LINK).collect()
    assert sorted((r.reason, bytes(r.line), r.cycle_year, r.source_file) for r in aside) == [
        ("bytes", b"H2|2022|2022|C\xe9|H|P|L2", 2022, "a.txt"), ("bytes", b"\xff", 2022, "a.txt")]
    wh = f"{scratch}/latin"
    assert _load(spark, root, wh, charset="ISO-8859-1") == {(2022, "a.txt"): ("new", 3, 1)}
    got = {r.cand_id: r.cmte_id for r in loader.read_table(spark, wh, LINK).collect()}
    assert got == {"H1": "C1", "H2": "Cé", "H3": "CÃ©"}
    assert [r.reason for r in loader.read_quarantine(spark, wh, LINK).collect()] == ["fields"]


def test_each_file_has_its_own_quoting(spark, scratch):
    root, wh = f"{scratch}/x", f"{scratch}/wh"
    _write(f"{root}/2022/ccl/quoted.txt", ['"H1"|2022|2022|"C|1"|H|P|L1', 'H2|2022|2022|"say ""so"""|H|P|"L2"',
                                           'H3|2022|2022|5" pipe|H|P|""'])
    _write(f"{root}/2022/ccl/stray.txt", ['H4|2022|2022|"C4|H|P|L4', 'H5|2022|2022|"C5"|H|P|L5'])
    _write(f"{root}/2022/ccl/plain.txt", [_line(6, 'C"6')])
    assert {s[1:] for s in _load(spark, root, wh).values()} == {(3, 0), (2, 0), (1, 0)}
    got = {r.cand_id: (r.cmte_id, r.linkage_id) for r in loader.read_table(spark, wh, LINK).collect()}
    assert got == {"H1": ("C|1", "L1"), "H2": ('say "so"', "L2"), "H3": ('5" pipe', None),
                   "H4": ('"C4', "L4"), "H5": ('"C5"', "L5"), "H6": ('C"6', "L6")}
    flags = {r.file_name: r.quoted for r in loader.manifest(spark, wh, LINK).collect()}
    assert flags == {"quoted.txt": True, "stray.txt": False, "plain.txt": False}


def test_odd_names_blank_lines_and_long_fields(spark, scratch):
    root, wh = f"{scratch}/x", f"{scratch}/wh"
    long = "x" * 200_000
    _write(f"{root}/2022/ccl/a b=%1+.txt", [_line(1), "", f'H2|2022|2022|"{long}"|H|P|L2'])
    _write(f"{root}/2022/ccl/only bad.txt", ["a|b", "c"])
    assert _load(spark, root, wh) == {(2022, "a b=%1+.txt"): ("new", 2, 0), (2022, "only bad.txt"): ("new", 0, 2)}
    assert _load(spark, root, wh) == {(2022, "a b=%1+.txt"): ("skipped", 2, 0),
                                      (2022, "only bad.txt"): ("skipped", 0, 2)}
    rows = {r.cand_id: r for r in loader.read_table(spark, wh, LINK).collect()}
    assert rows["H2"].cmte_id == long and rows["H1"].source_file == "a b=%1+.txt"


def test_nothing_to_load(spark, scratch):
    assert loader.load_filings(spark, f"{scratch}/none", f"{scratch}/wh", YEARS).count() == 0
    assert loader.read_table(spark, f"{scratch}/wh", "opensecrets_committees").count() == 0
    assert loader.read_quarantine(spark, f"{scratch}/wh", LINK).count() == 0
    with pytest.raises(FileNotFoundError):
        loader.read_table(spark, f"{scratch}/wh", LINK)
