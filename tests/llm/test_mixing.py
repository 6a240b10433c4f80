import math
import re

import duckdb
import pyarrow as pa
import pytest

from linkrank.llm import mixing, oracle
from llm.conftest import EDGE


def by_water(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    stopped, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in stopped)
        open_ = [s for s in names if s not in stopped]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in stopped else share[s] for s in names}
        stopped |= above


@pytest.fixture(scope="module")
def rows():
    out = list(EDGE)
    for i in range(1500):
        source = ("hot", "b", "a", "Ä", "z", None)[0 if i % 3 == 0 else i % 6]
        out.append((1000 + i, "w " * (1 + i * 7919 % 300) if i != 77 else "w\x1cw " * 9000, "en", source))
    return out


def test_against_sql_and_targets(documents, rows):
    frame = documents(rows)
    found = [tuple(r) for r in mixing.mix(frame).select("doc_id", "size", "source_size", "target", "copies", "source").collect()]
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "source": pa.array([r[3] for r in rows], pa.string())})
    database = duckdb.connect()
    database.register("documents", table)
    expected = database.execute(oracle.mixing_sql()).fetchall()
    assert sorted(repr((i, n, s, t, n * c)) for i, n, s, t, c, _ in found) == sorted(map(repr, expected))
    sizes: dict = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    goals = by_water(sizes)
    for source, goal in goals.items():
        mine = [f for f in found if f[5] == source]
        assert {f[2] for f in mine} <= {sizes[source]} and all(f[3] == pytest.approx(goal) for f in mine)
        taken = sum(f[1] * f[4] for f in mine)
        if sizes[source] > 5000:
            assert abs(taken - goal) <= 0.02 * goal
    assert all(0 <= f[4] <= 2 for f in found)
    again = [tuple(r) for r in mixing.mix(frame.repartition(7)).select("doc_id", "size", "source_size", "target", "copies", "source").collect()]
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_plain_method(documents, rows):
    """One offset, one rate: every source takes as many copies as whole numbers lie below its expected copies and the offset."""
    [offset] = mixing.offsets(3, 1)
    found = {(r.doc_id, r.source, r.size): r for r in mixing.mix(documents(rows), seed=3, draws=1, heavy_part=1).collect()}
    for source in {k[1] for k in found}:
        mine = [r for k, r in found.items() if k[1] == source]
        rate = mine[0].target / mine[0].source_size if mine[0].source_size else 0.0
        assert sum(r.copies for r in mine) == math.floor(rate * len(mine) + offset)
        assert {r.copies for r in mine} <= {math.floor(rate), math.ceil(rate)}


def test_rows_of_the_mix(documents, rows):
    frame = documents(rows)
    copies = {(r.doc_id, r.source, r.size): r.copies for r in mixing.mix(frame).collect()}
    mixed = mixing.mixed(frame)
    assert mixed.columns == frame.columns
    assert mixed.where("llm_words = 'x' and row = 'x' and of_size = 'x' and size = 'x'").count() == mixed.count() > 0
    expected = [repr((i, t, s)) for i, t, _, s in rows for _ in range(copies[i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))])]
    assert sorted(repr((r.doc_id, r.text, r.source)) for r in mixed.collect()) == sorted(expected)


def test_many_rows_alike_are_given_back_in_pieces(documents, rows, monkeypatch):
    rows = rows + [(None, "one two three", "en", "hot")] * 1000 + [(3, "a b", "en", "b")] * 12
    found = sorted(map(repr, map(tuple, mixing.mix(documents(rows)).collect())))
    assert len(found) == len(rows)
    monkeypatch.setattr(mixing, "ALIKE", 5)
    assert sorted(map(repr, map(tuple, mixing.mix(documents(rows)).collect()))) == found


def test_empty_tables_and_sizes(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixed(documents([])).count() == 0
    found = mixing.mix(documents([(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert [(r.target, r.copies) for r in found] == [(0.0, 0), (0.0, 0)]


def test_no_python_in_the_plan(documents, rows):
    plan = mixing.mix(documents(rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
