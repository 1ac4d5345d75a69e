import hashlib
from collections import Counter

import pytest

from checks.compare import connect, differences
from tablelift.llm import lines, queries
from tests.llm.conftest import LOW, odd_rows

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def _key(line):
    return line.strip(SPACE).translate(LOW)


def _wanted(rows, documents, least=1):
    split = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    held = Counter(k for _, own in split for k in {_key(x) for x in own})
    gone = {k for k, n in held.items() if n >= documents and len(k) >= least}
    out = []
    for i, own in split:
        kept = [x for x in own if _key(x) not in gone or not _key(x)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def _got(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


def _rows():
    rows = [(i, f"Header \n own line {i}\n\n\t{'FOOTER' if i % 2 else 'footer'}\r\nheader\nshared by {i % 7}") for i in range(60)]
    rows += [(100 + i, "Footer") for i in range(3)] + [(None, " header "), (None, "\n\n"), (103, "header"), (103, "header")]
    return [(i, t) for i, t in rows] + [(i, t) for i, t, *_ in odd_rows()]


def test_registered_query_equals_sql(spark):
    assert differences(queries.op13_line_dedup(spark, SF), connect(SF), queries.TWINS["op13_line_dedup"]) == []


def test_rows_nulls_and_clashing_names(spark, odd, none):
    assert _got(lines.without_common_lines(odd, documents=2)) == _wanted(odd_rows(), 2)
    assert lines.without_common_lines(none).collect() == []


@pytest.mark.parametrize("least", [1, 7])
def test_broadcast_and_join_equal_brute_force(spark, least):
    docs = spark.createDataFrame(_rows(), "doc_id long, text string").repartition(4)
    runs = lines.LineRuns(spark, 9, least)
    runs.add(docs)
    common = runs.common()
    wanted = _wanted(_rows(), 9, least)
    assert _got(lines.without_lines(docs, common, least)) == wanted
    assert _got(lines.without_lines(docs, common, least, most=1)) == wanted
    assert any(dropped for _, _, dropped, _ in wanted)


def test_batches_fill_levels_and_give_the_same_lines(spark):
    rows = _rows()
    frames = [spark.createDataFrame(rows[k::11], "doc_id long, text string") for k in range(11)]
    runs = lines.LineRuns(spark, 9, fanout=3)
    for frame in frames:
        runs.add(frame)
    assert [len(level) for level in runs.levels] == [2, 0, 1]
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(lines.without_lines(whole, runs.common())) == _wanted(rows, 9)
    # A key common in a run is not counted again by later batches.
    known = {r.h for r in runs.levels[2][0].where("n >= 9").collect()}
    assert known and not known & {r.h for run in runs.levels[0] for r in run.collect()}


def test_files_are_dealt_into_batches(spark, tmp_path):
    docs = spark.createDataFrame(_rows(), "doc_id long, text string").repartition(12)
    docs.write.parquet(str(tmp_path / "docs"))
    read = spark.read.parquet(str(tmp_path / "docs"))
    batches = lines.batches_of(read, 4)
    assert 2 <= len(batches) <= 4 and sum(b.count() for b in batches) == len(_rows())
    assert _got(lines.without_common_lines(read, 9)) == _wanted(_rows(), 9)
    assert len(lines.batches_of(docs)) == 1 and len(lines.batches_of(read.join(read, ["doc_id", "text"]))) == 1


def test_kept_digest(spark):
    got = {r.doc_id: r.kept_sha256 for r in queries.op13_line_dedup(spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, _, _, t in _wanted(rows, 10)}
