"""Parsing rules and their options."""

import pytest
from conftest import lines

from linkrank.sources import (
    parse_adjacency,
    parse_edges,
    parse_ranked,
    parse_records,
    read_adjacency,
    read_edges,
    read_ranked,
)

EDGE_CASES = ["# c\tx", "", "  \t", "a b c", "a\t\tb", " \tA\tB ", "D", "x y", "u  \t v", "p\tq\tr"]


def pairs(edges):
    return sorted((r.src, r.dst) for r in edges.collect())


def reasons(rejects):
    return sorted((r.value, r.reason) for r in rejects.collect())


def test_whitespace_exact(spark):
    edges, rejects = parse_edges(lines(spark, *EDGE_CASES))
    assert pairs(edges) == [("A", "B"), ("a", "b"), ("u", "v"), ("x", "y")]
    assert [v for v, _ in reasons(rejects)] == ["D", "a b c", "p\tq\tr"]


def test_whitespace_at_least(spark):
    edges, rejects = parse_edges(lines(spark, *EDGE_CASES), fields="at_least")
    assert pairs(edges) == [("A", "B"), ("a", "b"), ("a", "b"), ("p", "q"), ("u", "v"), ("x", "y")]
    assert [v for v, _ in reasons(rejects)] == ["D"]


def test_tab_keeps_comments_and_wants_both_sides(spark):
    edges, rejects = parse_edges(
        lines(spark, *EDGE_CASES), sep="tab", fields="at_least", comment=None
    )
    assert pairs(edges) == [("# c", "x"), ("A", "B"), ("p", "q"), ("u", "v")]
    assert ("a\t\tb", "empty node id") in reasons(rejects)


def test_bad_options(spark):
    with pytest.raises(ValueError):
        parse_edges(lines(spark, "a b"), sep="semicolon")
    with pytest.raises(ValueError):
        parse_edges(lines(spark, "a b"), fields="some")


def test_adjacency(spark):
    records, rejects = parse_adjacency(
        lines(spark, "E\tq,,r, ", "F\t", "", "\tx", "onlyone", "a\tb\tc\td", "G\tx ,y\r")
    )
    got = {r.id: r.neighbors for r in records.collect()}
    assert got == {"E": ["q", "r"], "F": [], "G": ["x", "y"]}
    assert [r for _, r in reasons(rejects)] == [
        "empty node id",
        "wrong field count",
        "wrong field count",
    ]


def test_ranked(spark):
    records, rejects = parse_ranked(
        lines(spark, "A\t0.25\tB,C", "B\t1e-3\t", "X\tabc\tY", "Y\t1d\t", "\t0.5\tz", "C\tD", "Z\t\t")
    )
    got = {r.id: (r["rank"], r.neighbors) for r in records.collect()}
    assert got == {"A": (0.25, ["B", "C"]), "B": (0.001, [])}
    assert sorted(r for _, r in reasons(rejects)) == [
        "empty node id",
        "invalid rank",
        "invalid rank",
        "invalid rank",
        "wrong field count",
    ]


def test_mixed_widths(spark):
    records, rejects = parse_records(lines(spark, "A\t0.25\tB", "B\tA", "C"))
    assert {r.id: r["rank"] for r in records.collect()} == {"A": 0.25, "B": None}
    assert rejects.count() == 1


def test_directories_skip_hidden_names(spark, tmp_path):
    (tmp_path / "part-0").write_text("a\tb\r\nb c\n")
    (tmp_path / "part-1").write_text("c a\n")
    (tmp_path / "_SUCCESS").write_text("never seen\n")
    assert pairs(read_edges(spark, str(tmp_path))) == [("a", "b"), ("b", "c"), ("c", "a")]
    assert pairs(read_edges(spark, str(tmp_path / "part-1"))) == [("c", "a")]


def test_record_files(spark, tmp_path):
    (tmp_path / "adj.txt").write_text("a\tb\nb\t\n")
    assert read_adjacency(spark, str(tmp_path / "adj.txt")).count() == 2
    with pytest.raises(ValueError, match="no valid"):
        read_ranked(spark, str(tmp_path / "adj.txt"))


def test_an_empty_comment_prefix_is_refused(spark):
    with pytest.raises(ValueError, match="prefix"):
        parse_edges(lines(spark, "a b"), comment="")
