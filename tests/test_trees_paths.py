import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsight.operators import paths, trees
from tests.conftest import rows_of

T0, T1 = "2024-03-01T01:00:00", "2024-03-01T02:00:00"
SINCE = datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def flows(make):
    return make("flow_name string, critical_ind string", [("F", "Y"), ("G", "N"), ("H", None)])


def test_failed_step_hides_what_is_below(runs, flows):
    df = runs([
        (1, None, 1, "F", T0, T1), (2, 1, 1, "F:A", T0, T1), (3, 2, 1, "F:B", T0, T1),
        (4, 1, 1, "F:C", T0, T1, "FAILED"), (5, 4, 1, "F:D", T0, T1),
        (6, None, 6, "G", T0, T1), (7, None, 7, "H", T0, T1), (8, None, 8, "X", T0, T1),
        (20, 21, 1, "F:LOOP1", T0, T1), (21, 20, 1, "F:LOOP2", T0, T1),
    ])
    tree = trees.flow_tree(df, flows, SINCE)
    assert rows_of(tree, "execution_audit_id", "root_execution_audit_id", "level", "is_leaf", "path") == [
        (1, 1, 1, False, "/F"), (2, 1, 2, False, "/F/A"), (3, 1, 3, True, "/F/A/B"), (6, 6, 1, True, "/G"),
    ]
    assert rows_of(trees.flow_tree(df, flows, SINCE, critical_ind="N"), "execution_audit_id") == [(6,)]
    assert rows_of(trees.flow_tree(df, flows, SINCE, flow_name="F"), "execution_audit_id") == [(1,), (2,), (3,)]


def test_a_leaf_is_one_without_child_in_the_filtered_set(runs, flows):
    df = runs([(1, None, 1, "F", T0, T1), (2, 1, 1, "F:A", T0, T1), (3, 2, 1, "F:B", T0, T1, "FAILED")])
    tree = trees.flow_tree(df, flows, SINCE)
    assert rows_of(tree, "execution_audit_id", "is_leaf") == [(1, False), (2, True)]


def test_walk_equals_level_loop_on_random_forests(spark):
    rng = random.Random(3)
    parent = {}
    for n in range(400):
        # chains, bushes, missing parents and one loop
        parent[n] = None if n % 50 == 0 else (n - 1 if rng.random() < 0.7 else rng.randrange(max(1, n)))
    for n in (17, 123, 301):
        parent[n] = 9999
    parent[390], parent[391] = 391, 390
    want = {}
    for n in parent:
        chain, at = [n], n
        while at is not None and parent.get(at) is not None and len(chain) < 500:
            at = parent[at]
            chain.append(at)
        if parent.get(at, -1) is None:
            want[n] = (at, len(chain), "/".join(str(c) for c in reversed(chain)))
    nodes = spark.createDataFrame(list(parent.items()), "id long, up long")
    got = trees.walk_from_roots(
        nodes, "id", "up", F.when(F.col("up").isNull(), F.col("id").cast("string"))
        .otherwise(F.concat(F.lit("/"), F.col("id").cast("string"))), F.struct(F.col("id").alias("id")),
    )
    assert {r["id"]: (r["root"]["id"], r["level"], r["path"]) for r in got.collect()} == want


def test_a_long_chain_needs_few_rounds(spark):
    nodes = spark.range(2000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    got = trees.walk_from_roots(nodes, "id", "up", F.array("id"), F.struct("id"), max_rounds=12)
    last = got.where("id = 1999").first()
    assert last["level"] == 2000 and last["path"] == list(range(2000)) and got.count() == 2000


def test_heaviest_leaves_and_history(runs, flows):
    df = runs([
        (1, None, 1, "F", T0, "2024-03-01T09:00:00"),
        (2, 1, 1, "F:A", T0, "2024-03-01T03:00:00"), (3, 1, 1, "F:B", T0, "2024-03-01T04:00:00"),
        (4, 1, 1, "F:C", T0, "2024-03-01T04:00:00", "COMPLETE", "PLSQLFunction"),
        (5, 1, 1, "F:D", T0, "2024-03-01T08:00:00", "COMPLETE", "ProcessFlow"),
        (6, 99, 99, "F:B", "2024-02-20T01:00:00", "2024-02-20T01:30:00"),
        (7, 99, 99, "F:B", "2024-01-01T01:00:00", "2024-01-01T01:30:00"),
    ])
    top = trees.heaviest_leaves(trees.flow_tree(df, flows, datetime(2024, 2, 25)), 2)
    assert rows_of(top, "ranking", "execution_audit_id", "type", "duration_mins") == [
        (1, 3, "Mapping", 180.0), (2, 4, "Function", 180.0),
    ]
    hist = trees.heavy_leaf_history(top, df, datetime(2024, 3, 2), 30).collect()
    assert [(r["ranking"], r["execution_audit_id"]) for r in hist] == [(1, 3), (1, 6), (2, 4)]


def test_depth_first_order_goes_by_label(make):
    df = make("employee_id long, manager_id long, last_name string", [
        (1, None, "King"), (2, 1, "Zlotkey"), (3, 1, "Cambrault"), (4, 2, "Abel"), (5, 3, "Bates"), (6, None, "Adams"),
    ])
    got = [(r["level"], r["label"]) for r in trees.hierarchy_depth_first(df).collect()]
    assert got == [(1, "**Adams"), (1, "**King"), (2, "****Cambrault"), (3, "******Bates"), (2, "****Zlotkey"),
                   (3, "******Abel")]


def test_a_node_without_label_comes_last(make):
    df = make("employee_id long, manager_id long, last_name string", [
        (1, None, "King"), (2, 1, None), (3, 1, "Zlotkey"), (4, 2, "Abel"), (5, None, None),
    ])
    got = [(r["level"], r["label"]) for r in trees.hierarchy_depth_first(df).collect()]
    assert got == [(1, "**King"), (2, "****Zlotkey"), (2, "****"), (3, "******Abel"), (1, "**")]


def test_number_rows(spark):
    assert [r["n"] for r in trees.number_rows(spark, 10).orderBy("n").collect()] == list(range(1, 11))


STEPS = ("execution_audit_id long, prev_execution_audit_id long, prev_created_on timestamp_ntz, "
         "prev_execution_name_short string, execution_name_short string, type string, cnt long, duration_mins double, "
         "p80_duration_mins double, top_level_execution_audit_id long, root_execution_name string, "
         "root_created_on timestamp_ntz, root_updated_on timestamp_ntz")


@pytest.fixture(scope="module")
def steps(make):
    def build(rows, names=None):
        """(id, previous id, minutes); several rows per id are several predecessors."""
        names = names or {}
        count = {}
        for r in rows:
            count[r[0]] = count.get(r[0], 0) + 1
        return make(STEPS, [
            (i, p, None if p is None else T0, None if p is None else names.get(p, f"S{p}"), names.get(i, f"S{i}"), "Mapping",
             count[i], m, None, 1, "F", T0, T1) for i, p, m in rows
        ])

    return build


def _all_chains(rows):
    by_prev = {}
    for r in rows:
        by_prev.setdefault(r[1], []).append(r)
    out, stack = [], [([r[0]], [r[2]], r) for r in rows if r[1] is None]
    while stack:
        ids, mins, last = stack.pop()
        out.append((tuple(ids), None if None in mins else round(sum(mins), 6), last))
        for r in by_prev.get(ids[-1], []):
            if r[0] not in ids:
                stack.append((ids + [r[0]], mins + [r[2]], r))
    return [c for c in out if c[2][1] is not None]


def test_paths_sums_and_pairs(steps):
    got = paths.sequence_paths(steps([(1, None, 1.0), (2, 1, 2.5), (3, 2, None), (4, 3, 4.0)]))
    assert rows_of(got, "execution_audit_id", "seq_length", "path_duration_mins", "pair_duration_mins", "is_leaf") == [
        (2, 2, 3.5, 3.5, False), (3, 3, None, None, False), (4, 4, None, None, True),
    ]
    assert got.where("execution_audit_id = 2").first()["seq_path"] == (
        " -->S1 [1, p80-, TYPE:Mapping] -->S2 [2.5, p80-, TYPE:Mapping]"
    )


def test_paths_equal_brute_force_with_branches_and_loops(steps):
    rng = random.Random(11)
    rows = [(0, None, 1.0), (100, None, 2.0)]
    for n in range(1, 22):
        for p in sorted(rng.sample(range(max(0, n - 4), n), k=min(n, rng.choice([1, 1, 2])))):
            rows.append((n, p, float(n)))
    rows += [(5, 8, 1.0), (3, 100, 4.0)]  # a loop back and a second start
    got = paths.sequence_paths(steps(rows))
    want = sorted((ids, mins) for ids, mins, _ in _all_chains(rows))
    have = sorted((tuple(r["step_ids"]), r["path_duration_mins"]) for r in got.collect())
    assert have == want


@pytest.mark.parametrize("seed", range(3))
def test_critical_chains_need_not_build_every_chain(steps, seed):
    rng = random.Random(seed)
    rows = [(0, None, 1.0)]
    for n in range(1, 25):
        for p in sorted(rng.sample(range(max(0, n - 5), n), k=min(n, rng.choice([1, 2, 3])))):
            rows.append((n, p, rng.choice([None, 1.0, 2.0, 3.0, float(n)])))
    df = steps(rows)
    assert rows_of(paths.critical_chains(df)) == rows_of(paths.critical_path(paths.sequence_paths(df)))


def test_critical_chains_with_a_loop(steps):
    rows = [(1, None, 1.0), (2, 1, 100.0), (3, 2, 10.0), (2, 3, 100.0), (4, 3, 1.0), (5, 2, 1.0), (5, 4, 1.0), (6, 5, 1.0)]
    assert rows_of(paths.critical_chains(steps(rows))) == rows_of(paths.critical_path(paths.sequence_paths(steps(rows))))


@pytest.mark.parametrize("seed", range(3))
def test_critical_chains_equal_every_chain_with_loops(steps, seed):
    rng = random.Random(seed)
    rows = [(0, None, 1.0)]
    for n in range(1, 14):
        for p in sorted(rng.sample(range(max(0, n - 4), n), k=min(n, rng.choice([1, 2])))):
            rows.append((n, p, float(rng.randrange(1, 50))))
    for _ in range(3):
        b = rng.randrange(1, 12)
        back = (b, rng.randrange(b, 14))
        if back not in {r[:2] for r in rows}:
            rows.append((*back, float(rng.randrange(1, 50))))
    df = steps(rows)
    assert rows_of(paths.critical_chains(df)) == rows_of(paths.critical_path(paths.sequence_paths(df)))


@pytest.mark.parametrize("seed", range(4))
def test_loop_steps_equal_reachability(make, seed):
    """A step is given if a loop leads to it and it leads to a loop."""
    rng = random.Random(seed)
    links = {(n - 1, n) for n in range(1, 30)} | {(rng.randrange(60), rng.randrange(60)) for _ in range(25)}
    reach = {n: {n} for n in range(60)}
    for _ in range(60):
        for a, b in links:
            reach[a] |= reach[b]
    on_loop = {n for n in range(60) if any(a == n and n in reach[b] for a, b in links)}
    low = min((b for a, b in links if a >= b), default=None)
    high = max((a for a, b in links if a >= b), default=None)
    within = {n for n in range(60) if low is not None and low <= n <= high}
    want = {n for n in within if any(n in reach[m] for m in on_loop) and reach[n] & on_loop}
    got = paths._loop_steps(make("execution_audit_id long, prev_execution_audit_id long", [(b, a) for a, b in links]))
    have = [] if got is None else [r[0] for r in got.collect()]
    # a way between two loops may leave the range of the links that go back; steps on loops never do
    assert len(have) == len(set(have)) and on_loop <= set(have) <= want


def test_a_long_chain_beside_a_loop_takes_few_rounds(make, monkeypatch):
    rounds, splice = [], paths._splice
    monkeypatch.setattr(paths, "_splice", lambda links: rounds.append(1) or splice(links))
    chain = [(n, n - 1) for n in range(1, 10_000)]
    steps = make("execution_audit_id long, prev_execution_audit_id long", [*chain, (20_000, 20_001), (20_001, 20_000), (0, 10_500), (10_500, 10_500)])
    got = paths._loop_steps(steps)
    assert sorted(r[0] for r in got.collect()) == [10_500, 20_000, 20_001] and len(rounds) <= 40


def test_junctions_show_only_with_a_single_predecessor(steps):
    rows = [(1, None, 1.0), (2, 1, 1.0), (3, 1, 1.0), (3, 2, 1.0), (4, 2, 1.0)]
    got = paths.sequence_paths(steps(rows, {2: "AND_7"}))
    assert rows_of(got, "execution_audit_id", "prev_execution_audit_id") == [(2, 1), (3, 1), (4, 2)]


def test_critical_path_ties_go_to_the_longer_chain(steps):
    rows = [(1, None, 1.0), (2, 1, 4.0), (3, 1, 2.0), (4, 3, 2.0), (5, 1, None)]
    got = paths.critical_path(paths.sequence_paths(steps(rows))).collect()
    assert got == paths.critical_chains(steps(rows)).collect()
    assert [(r["path_duration_mins"], r["seq_length"], r["max_length"], r["max_path_dur_mins"]) for r in got] == [
        (5.0, 3, 3, 5.0)
    ]


def test_no_critical_path_where_every_duration_is_unknown(steps):
    df = steps([(1, None, None), (2, 1, 1.0)])
    assert paths.critical_path(paths.sequence_paths(df)).count() == 0
    assert paths.critical_chains(df).count() == 0
