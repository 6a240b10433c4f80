"""The ranking loop: options, invariants, skew, and the shape of its plans."""

import random
import re
import shutil
from collections import Counter
from pathlib import Path

import pytest
from conftest import edge_frame
from pyspark.sql import functions as F

from linkrank import Workspace, prepare, prepare_records, rank, resume, runs
from linkrank.operators import metrics
from linkrank.operators.metrics import compare
from linkrank.operators.step import rank_step
from linkrank.plans import graph as graph_module
from linkrank.plans import iterate
from linkrank.plans.graph import partition_count
from linkrank.plans.history import open_history, store_history
from linkrank.plans.journal import Journal
from linkrank.plans.workspace import shared_folder, shuffle_partitions
from linkrank.sinks import compare_runs, reports, run_summary


def brute_force(pairs, iterations, dedupe=True, nodes=None, unknown="drop", damping=0.85, start=None):
    """Ranks by plain dictionaries: ``(ranks per iteration)``."""
    counted = Counter(set(pairs) if dedupe else pairs)
    members = set(nodes) if nodes is not None else {x for pair in counted for x in pair}
    degree = Counter()
    for (src, _), copies in counted.items():
        degree[src] += copies
    n = len(members)
    ranks = dict(start) if start else dict.fromkeys(members, 1.0 / n)
    history = [ranks]
    for _ in range(iterations):
        dangling = sum(r for x, r in ranks.items() if not degree[x])
        incoming = Counter()
        for (src, dst), copies in counted.items():
            if src in ranks:
                incoming[dst] += copies * ranks[src] / degree[src]
        known = set(ranks) | (set(incoming) if unknown == "materialize" else set())
        ranks = {
            x: (1 - damping) / n + damping * (incoming[x] + dangling / n) for x in known
        }
        history.append(ranks)
    return history


def random_pairs(seed, nodes=40, count=160, hub=0):
    rng = random.Random(seed)
    pairs = [(f"v{rng.randrange(nodes)}", f"v{rng.randrange(nodes)}") for _ in range(count)]
    pairs += [("v0", f"x{i}") for i in range(hub)] + [(f"x{i}", "v1") for i in range(0, hub, 2)]
    pairs += [("v0", "v2")] * (hub // 2)
    rng.shuffle(pairs)
    return pairs


def as_dict(ranks):
    rows = ranks.collect()
    found = {r.id: r["rank"] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize(
    ("dedupe", "heavy_rows"), [(True, 1_000_000), (True, 20), (False, 1_000_000), (False, 20)]
)
def test_matches_brute_force(spark, dedupe, heavy_rows):
    """Three iterations on a graph with a hub, with and without splitting off its edges."""
    pairs = random_pairs(5, hub=90)
    with Workspace(spark) as space:
        graph = prepare(
            edge_frame(spark, pairs), dedupe=dedupe, heavy_rows=heavy_rows, workspace=space
        )
        assert (graph.links.heavy is not None) == (heavy_rows == 20)
        result = rank(graph, tol=None, max_iter=3)
        expected = brute_force(pairs, 3, dedupe)[-1]
        assert as_dict(result.ranks) == pytest.approx(expected, abs=1e-14)
        assert graph.n == len(expected)
        assert graph.n_edges == (len(set(pairs)) if dedupe else len(pairs))
        stats = graph.stats().first()
        assert (stats.nodes, stats.edges, stats.dangling) == (
            graph.n,
            graph.n_edges,
            graph.n_dangling,
        )


def test_total_stays_one_with_dangling_nodes(spark):
    """The dangling mass of an iteration must be that of the ranks it starts from."""
    pairs = random_pairs(9, nodes=60, count=70)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space)
        assert graph.n_dangling > 0
        result = rank(graph, tol=None, max_iter=6)
        for row in result.history.collect():
            assert row.total_rank == pytest.approx(1.0, abs=1e-12)
        ranks = as_dict(result.ranks)
        assert len(ranks) == graph.n and min(ranks.values()) >= 0.15 / graph.n


def test_order_and_names_do_not_matter(spark):
    pairs = random_pairs(13)
    renamed = [(f"name of {a}", f"name of {b}") for a, b in reversed(pairs)]
    with Workspace(spark) as space, Workspace(spark) as other:
        first = rank(
            prepare(edge_frame(spark, pairs), workspace=space), tol=None, max_iter=2
        ).ranks
        second = rank(
            prepare(edge_frame(spark, renamed).repartition(5), workspace=other),
            tol=None,
            max_iter=2,
        ).ranks
        assert {f"name of {k}": v for k, v in as_dict(first).items()} == pytest.approx(
            as_dict(second), abs=1e-12
        )


@pytest.mark.parametrize("policy", ["drop", "materialize"])
def test_unknown_targets(spark, policy):
    records = [("a", ["b", "zz"]), ("b", ["a", "a", "zz"]), ("lonely", [])]
    frame = spark.createDataFrame(records, "id string, neighbors array<string>")
    pairs = [(src, dst) for src, targets in records for dst in targets]
    with Workspace(spark) as space:
        graph = prepare_records(frame, workspace=space)
        assert (graph.n, graph.n_dangling) == (3, 1)
        result = rank(graph, tol=None, max_iter=3, unknown_targets=policy)
        expected = brute_force(pairs, 3, False, [r[0] for r in records], policy)[-1]
        assert as_dict(result.ranks) == pytest.approx(expected, abs=1e-14)
        assert ("zz" in expected) == (policy == "materialize")


def test_isolated_nodes_and_lists_in_parts(spark):
    parts = spark.createDataFrame(
        [("a", ["b"]), ("a", ["c"]), ("b", []), ("c", ["a"])],
        "id string, neighbors array<string>",
    )
    with Workspace(spark) as space:
        with pytest.raises(ValueError, match="more than one record"):
            prepare_records(parts, workspace=space, unique=True)
        graph = prepare_records(parts, workspace=space)
        assert (graph.n, graph.n_edges, graph.n_dangling) == (3, 3, 1)


@pytest.mark.parametrize("policy", ["drop", "materialize"])
def test_a_resumed_run_is_the_uninterrupted_one(spark, policy):
    records = spark.createDataFrame([("a", ["b", "zz"]), ("b", ["a"])], "id string, neighbors array<string>")
    with Workspace(spark) as space:
        graph = prepare_records(records, workspace=space)
        whole = rank(graph, tol=None, max_iter=4, unknown_targets=policy)
        first = rank(graph, tol=None, max_iter=2, unknown_targets=policy)
        ranks = first.ranks.union(spark.createDataFrame([], first.ranks.schema))
        # Through records of all ranked nodes the count of nodes grows, but not the N of the run.
        grown = prepare_records(first.ranks.select("id").join(records, "id", "left").select("id", F.expr("coalesce(neighbors, array()) AS neighbors")), space)
        second = rank(grown, tol=None, max_iter=2, unknown_targets=policy, initial_ranks=ranks, n=first.n, first_iteration=3, history=first.history)
        assert as_dict(second.ranks) == pytest.approx(as_dict(whole.ranks), abs=1e-14)
        assert second.iterations == 4
        for a, b in zip(second.history_rows, whole.history_rows, strict=True):
            assert a[0] == b[0] and a[1:3] == pytest.approx(b[1:3], abs=1e-14)
            assert all((x is None) == (y is None) and (x is None or abs(x - y) < 1e-14) for x, y in zip(a[3:6], b[3:6], strict=True))


@pytest.mark.parametrize("keep_history", [True, False])
def test_a_named_workspace_is_gone_on_with_in_another_session(spark, keep_history):
    pairs = random_pairs(41, hub=30)
    name = f"kept_{keep_history}".lower()
    rank(prepare(edge_frame(spark, pairs), workspace=Workspace(spark, name=name), heavy_rows=20, dedupe=False).without_copies(), tol=None, max_iter=3, keep_history=keep_history)
    other, name = lost(spark, name)
    result = resume(other, name, max_iter=6)
    assert as_dict(result.ranks) == pytest.approx(brute_force(pairs, 6)[-1], abs=1e-14)
    assert [r[0] for r in result.history_rows] == [1, 2, 3, 4, 5, 6]
    again = resume(other, name, max_iter=6)
    assert again.iterations == 6 and as_dict(again.ranks) == as_dict(result.ranks)
    with pytest.raises(ValueError, match="no finished iteration"):
        resume(spark, f"{name}_none")


def lost(spark, name):
    """What a lost driver takes along is the catalog; the files stay. Here they stay under another name."""
    shutil.copytree(f"{shared_folder(spark)}/{name}", f"{shared_folder(spark)}/{name}_found")
    return spark.newSession(), f"{name}_found"


def test_the_newest_run_is_resumed_not_the_longest(spark):
    first, second = random_pairs(51), random_pairs(53, nodes=30)
    space = Workspace(spark, name="two_runs")
    rank(prepare(edge_frame(spark, first), workspace=space), tol=None, max_iter=5, damping=0.5)
    rank(prepare(edge_frame(spark, second), workspace=space), tol=None, max_iter=2, keep_history=True)
    other, name = lost(spark, "two_runs")
    result = resume(other, name, max_iter=4)
    assert (result.run, result.iterations) == (2, 4)
    assert as_dict(result.ranks) == pytest.approx(brute_force(second, 4)[-1], abs=1e-14)
    assert as_dict(result.snapshot(1)) == pytest.approx(brute_force(second, 1)[-1], abs=1e-14)
    earlier = resume(other, name, max_iter=6, run=1)
    assert (earlier.run, earlier.iterations, earlier.damping) == (1, 6, 0.5)
    assert as_dict(earlier.ranks) == pytest.approx(brute_force(first, 6, damping=0.5)[-1], abs=1e-14)
    assert [tuple(r)[:4] for r in runs(other, name).collect()] == [(1, 6, 6, False), (2, 4, 4, False)]
    with pytest.raises(ValueError, match="number 3"):
        resume(other, name, run=3)


@pytest.mark.parametrize("given", [False, True])
def test_a_run_cut_off_before_its_first_iteration(spark, monkeypatch, given):
    first, second = random_pairs(55), random_pairs(57, nodes=30)
    name = f"cut_off_{given}".lower()
    space = Workspace(spark, name=name)
    rank(prepare(edge_frame(spark, first), workspace=space), tol=None, max_iter=3)
    graph = prepare(edge_frame(spark, second), workspace=space)
    half = rank(graph, tol=None, max_iter=1)

    def stop(*_):
        raise RuntimeError("the driver is lost")

    options = {"initial_ranks": half.ranks, "first_iteration": 2, "history": half.history} if given else {}
    with monkeypatch.context() as patch:
        patch.setattr(iterate, "rank_step", stop)
        with pytest.raises(RuntimeError, match="lost"):
            rank(graph, tol=None, max_iter=2, **options)
    result = resume(*lost(spark, name))
    assert result.run == 3 and [r[0] for r in result.history_rows] == ([1, 2, 3] if given else [1, 2])
    assert as_dict(result.ranks) == pytest.approx(brute_force(second, result.iterations)[-1], abs=1e-14)


def test_a_note_half_written_does_not_count(spark):
    pairs = random_pairs(59)
    rank(prepare(edge_frame(spark, pairs), workspace=Workspace(spark, name="half_noted")), tol=None, max_iter=3)
    other, name = lost(spark, "half_noted")
    journal = f"{shared_folder(spark)}/{name}/_journal"
    shutil.copytree(f"{journal}/run=000000001/number=000000003", f"{journal}/run=000000002/number=000000000")
    Path(f"{journal}/run=000000002/number=000000000/_SUCCESS").unlink()
    Path(f"{journal}/run=000000001/number=000000003/_SUCCESS").unlink()
    space = Workspace.reopen(other, name)
    assert Journal(space).newest()[:2] == (1, 2)
    assert Journal(space).begin({"a": 1}) == 3


@pytest.mark.parametrize("unknown", ["drop", "materialize"])
def test_history_and_ranks_do_not_depend_on_the_partitions(spark, unknown):
    """The same bits from three partitionings, and from edges in three orders."""
    pairs = random_pairs(61, nodes=300, count=3000, hub=200)
    found = set()
    for parts in (1, 3, 7):
        random.Random(parts).shuffle(pairs)
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            with Workspace(spark) as space:
                records = edge_frame(spark, pairs).repartition(parts).groupBy(F.col("src").alias("id")).agg(F.collect_list("dst").alias("neighbors"))
                records = records.where("id <> 'v3'")
                for heavy in (1_000_000, 50):
                    graph = prepare_records(records, space, stage=True, heavy_rows=heavy)
                    result = rank(graph, tol=None, max_iter=4, unknown_targets=unknown)
                    ranks = sorted(as_dict(result.ranks).items())
                    again = (tuple(metrics.rank_total(result.ranks).first()), tuple(metrics.dangling_mass(result.ranked_nodes).first()))
                    found.add(repr(([r[:-1] for r in result.history_rows], ranks, again)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 1


def test_totals_far_from_one(spark):
    """Given ranks need not add up to one, and where targets become nodes the total may grow from step to step."""
    pairs = random_pairs(63, nodes=50)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space)
        for size in (1e-9, 1e6, 1e12):
            start = {x: size * (k + 1) for k, x in enumerate(sorted({x for p in pairs for x in p}))}
            given = spark.createDataFrame(list(start.items()), "id string, rank double")
            result = rank(graph, tol=None, max_iter=3, initial_ranks=given)
            expected = brute_force(pairs, 3, start=start)[-1]
            assert as_dict(result.ranks) == pytest.approx(expected, rel=1e-11)
            assert result.history_rows[-1][1] == pytest.approx(sum(expected.values()), rel=1e-12)
        few = spark.createDataFrame([("a", [f"t{k}" for k in range(300)])], "id string, neighbors array<string>")
        result = rank(prepare_records(few, space), tol=None, max_iter=6, unknown_targets="materialize")
        expected = brute_force([("a", f"t{k}") for k in range(300)], 6, nodes=["a"], unknown="materialize")[-1]
        assert as_dict(result.ranks) == pytest.approx(expected, rel=1e-12)


def test_several_graphs_in_one_workspace(spark):
    with Workspace(spark) as space:
        graphs = [prepare(edge_frame(spark, random_pairs(s)), workspace=space) for s in (43, 47)]
        for graph, s in zip(graphs, (43, 47), strict=True):
            assert as_dict(rank(graph, tol=None, max_iter=2).ranks) == pytest.approx(brute_force(random_pairs(s), 2)[-1], abs=1e-14)
        with pytest.raises(ValueError, match="no nodes"):
            prepare(edge_frame(spark, []), workspace=space)
        assert graphs[0].nodes.count() == graphs[0].n


def test_seconds_have_preparation_and_iterations(spark):
    with Workspace(spark) as space:
        result = rank(prepare(edge_frame(spark, random_pairs(3)), workspace=space), tol=None, max_iter=2)
        row = run_summary(result, "x").first()
        assert row.preparation_seconds > 0
        assert row.seconds == pytest.approx(row.preparation_seconds + sum(r[-1] for r in result.history_rows))


def test_first_iteration_rule(spark):
    """A ring is uniform from the start."""
    ring = [(str(i), str((i + 1) % 5)) for i in range(5)]
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, ring), workspace=space)
        assert rank(graph).iterations == 2
        assert rank(graph, first_iteration_can_converge=True).iterations == 1


def test_last_iteration_is_returned_without_convergence(spark):
    pairs = random_pairs(17)
    with Workspace(spark) as space:
        result = rank(prepare(edge_frame(spark, pairs), workspace=space), tol=1e-12, max_iter=2)
        assert (result.iterations, result.converged) == (2, False)
        assert as_dict(result.ranks) == pytest.approx(brute_force(pairs, 2)[-1], abs=1e-14)


def test_resume_continues_the_run(spark):
    pairs = random_pairs(21, hub=30)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space)
        half = rank(graph, tol=None, max_iter=2)
        whole = rank(graph, tol=None, max_iter=2, initial_ranks=half.ranks)
        assert as_dict(whole.ranks) == pytest.approx(brute_force(pairs, 4)[-1], abs=1e-14)
        change = compare(whole.ranks, half.ranks).first()
        assert change.nodes == graph.n and change.max_delta > 0

        stranger = spark.createDataFrame([("nobody", 1.0)], "id string, rank double")
        with pytest.raises(ValueError, match="nobody"):
            rank(graph, initial_ranks=stranger)
        with pytest.raises(ValueError, match="more than one"):
            rank(graph, initial_ranks=half.ranks.union(half.ranks))


def test_arguments_are_checked(spark):
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, [("a", "b")]), workspace=space)
        for wrong in (
            {"damping": 1.0},
            {"damping": 0.0},
            {"max_iter": 0},
            {"max_iter": 2.5},
            {"tol": 0.0},
            {"rule": "median"},
            {"unknown_targets": "ignore"},
        ):
            with pytest.raises(ValueError):
                rank(graph, **wrong)
        with pytest.raises(ValueError, match="negative"):
            rank_step(graph.links, graph.start_state(), graph.n, -0.1)
        with pytest.raises(ValueError, match="no nodes"):
            rank_step(graph.links, graph.start_state(), 0, 0.0)
        with pytest.raises(KeyError):
            rank(graph, max_iter=2, tol=None).snapshot(1)


@pytest.mark.parametrize("level", [1, 2])
def test_colliding_keys_are_replaced(spark, monkeypatch, level):
    """A hash that maps different ids to one key must not merge them."""

    def colliding(id_):
        return F.length(id_).cast("long")

    keys = [colliding] * level + list(graph_module.KEYS[level:])
    monkeypatch.setattr(graph_module, "KEYS", tuple(keys))
    pairs = random_pairs(25, hub=30)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space, heavy_rows=20)
        assert graph.key is keys[level]
        ranks = as_dict(rank(graph, tol=None, max_iter=2).ranks)
        assert ranks == pytest.approx(brute_force(pairs, 2)[-1], abs=1e-14)


def test_one_exchange_per_iteration(spark):
    """Links and state are read in their buckets; only the partial sums are shuffled."""
    with Workspace(spark) as space:
        graph = prepare(
            edge_frame(spark, random_pairs(29, nodes=400, count=3000)).repartition(4),
            workspace=space,
        )
        with shuffle_partitions(spark, graph.partitions):
            state = space.save(graph.start_state(), "state", "id", graph.partitions)
            plan = rank_step(graph.links, state, graph.n, 0.1)._jdf.queryExecution()
            physical = plan.executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", physical)) == 1
        assert "BroadcastExchange" not in physical and "Cartesian" not in physical
        assert "Python" not in physical and "Sort" not in physical
        # Contributions are summed before they are shuffled.
        exchange = physical.index("Exchange hashpartitioning")
        assert "partial_sum" in physical[exchange:] and "ShuffledHashJoin" in physical[exchange:]


def test_plan_does_not_grow(spark):
    pairs = random_pairs(31)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space)
        sizes = [
            len(rank(graph, tol=None, max_iter=i).state._jdf.queryExecution().toString())
            for i in (1, 4)
        ]
        assert abs(sizes[0] - sizes[1]) < 100


def test_input_need_not_be_copied(spark):
    pairs = random_pairs(37, hub=30)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space, heavy_rows=20)
        staged = prepare(edge_frame(spark, pairs), workspace=space, stage=True)
        assert (staged.n, staged.n_edges) == (graph.n, graph.n_edges)
        assert not [r for r in spark.sql(f"SHOW TABLES IN {space.database}").collect() if r.tableName.startswith(("edges", "ids"))]
        assert as_dict(rank(graph, tol=None, max_iter=2).ranks) == pytest.approx(
            brute_force(pairs, 2)[-1], abs=1e-14
        )


def test_rows_without_an_id_are_no_edges(spark):
    with Workspace(spark) as space:
        graph = prepare(
            edge_frame(spark, [("a", "b"), (None, "c"), ("d", None)]), workspace=space
        )
        assert (graph.n, graph.n_edges) == (2, 1)


def test_partitions_follow_the_data():
    assert partition_count(8, 10, 10) == 1
    assert partition_count(8, 600_000, 20_000) == 8
    assert partition_count(200, 10**12, 10**10) == 31_250
    assert partition_count(200, 10**12, 10**13) == graph_module.MAX_BUCKETS


def test_tables_live_in_the_shared_folder_and_are_dropped(spark, tmp_path):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    with Workspace(spark) as space:
        assert space.location.startswith(shared_folder(spark))
        result = rank(
            prepare(edge_frame(spark, [("a", "b")]), workspace=space), tol=None, max_iter=3
        )
        names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {space.database}").collect()}
        # The last state only; earlier ones are gone.
        assert len([n for n in names if n.startswith("run")]) == 1
        assert result.ranks.count() == 2
        before = spark.conf.get("spark.sql.shuffle.partitions")
    assert space.database not in {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_places_of_all_nodes_are_compared_in_their_buckets(spark, monkeypatch):
    pairs = random_pairs(67, nodes=60, hub=40)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), dedupe=False, workspace=space)
        runs_ = rank(graph.without_copies(), tol=None, max_iter=2), rank(graph, tol=None, max_iter=2)
        want = sorted(map(tuple, compare_runs(*runs_, k=graph.n).collect()))
        monkeypatch.setattr(reports, "FEW", 3)
        found = compare_runs(*runs_, k=graph.n)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
        assert sorted(map(tuple, found.collect())) == want
        assert sorted(r.place for r in found.collect()) == list(range(1, graph.n + 1))


def test_a_stored_history_is_read_in_its_buckets(spark, tmp_path):
    pairs = random_pairs(71, nodes=300, count=2500)
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space)
        result = rank(graph, tol=None, max_iter=4, keep_history=True)
        store_history(result, str(tmp_path / "history"))
        rows = [(r.iteration, r.id, r["rank"]) for r in spark.read.parquet(str(tmp_path / "history")).collect()]
        assert sorted(rows) == sorted((r.iteration, r.id, r["rank"]) for r in result.snapshots().collect())
    with Workspace(spark.newSession()) as space:
        stored = open_history(space, str(tmp_path / "history"))
        assert stored.columns == ["iteration", "key", "id", "out_degree", "rank"]
        history = metrics.history_of_snapshots(stored, by="key")
        plan = history._jdf.queryExecution().executedPlan().toString()
        # The only exchange is that of the sums, by iteration.
        assert re.findall(r"Exchange hashpartitioning\((\w+)", plan) == ["iteration"] and "Window" in plan
        found = [tuple(r) for r in history.orderBy("iteration").collect()]
        assert [r[:6] for r in found] == [r[:6] for r in result.history_rows]
