import random
from datetime import datetime

import pytest

from opsight.operators import contains, lineage as lin
from tests.conftest import plan_of, rows_of


def _brute(texts, names):
    return sorted((i, n) for i, t in texts if t is not None for n in {x for x in names if x} if n in t)


def test_contains_equals_brute_force(make):
    rng = random.Random(8)
    letters = "aab.Xé_日😀"
    texts = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 160)))) for i in range(80)] + [(999, None)]
    names = ["", None]
    for i, t in texts[:60]:
        for length in (1, 2, 3, 5, 8, 12, 16, 20, 33, 40, 64, 90):
            if len(t) > length and rng.random() < 0.3:
                at = rng.randrange(len(t) - length)
                names.append(t[at : at + length])
    names += ["zz" * k for k in (1, 4, 20)]
    got = contains.contains_pairs(
        make("id long, body string", texts), ["id"], "body", make("word string", [(n,) for n in names]), "word"
    )
    assert rows_of(got, "id", "word") == _brute(texts, [n for n in names if n])


def test_a_shared_prefix_does_not_join_all_names(make):
    """Names of one owner share their start; the chosen run must tell them apart."""
    names = [f"WAREHOUSE_STAGING_AREA.TABLE_{i:05d}_FACTS" for i in range(300)]
    texts = [(i, f"select * from {n}") for i, n in enumerate(names)]
    got = contains.contains_pairs(
        make("id long, body string", texts), ["id"], "body", make("word string", [(n,) for n in names]), "word"
    )
    assert rows_of(got, "id", "word") == sorted((i, n) for i, n in enumerate(names))


def test_texts_and_names_meet_by_hash_in_built_in_functions(make):
    texts = make("id long, body string", [(1, "some words"), (2, "others")])
    names = make("word string", [("words",), ("thers",)])
    got = contains.contains_pairs(texts, ["id"], "body", names, "word")
    assert rows_of(got) == [(1, "words"), (2, "thers")]
    plan = plan_of(got)
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert contains.contains_pairs(texts, ["id"], "body", names.where("1 = 0"), "word").count() == 0


def test_given_pairs_are_confirmed_with_a_text_in_one_row(make, monkeypatch):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("abc.") for _ in range(40))) for i in range(30)] + [(50, None), (51, "")]
    wanted = [(rng.randrange(52), "".join(rng.choice("abc.") for _ in range(rng.randint(0, 3)))) for _ in range(900)]
    wanted += [(3, None), (None, "a")]
    for limit in (1000, 4):
        monkeypatch.setattr(contains, "NAMES_AT_ONCE", limit)
        got = contains.confirmed_pairs(make("id long, word string", wanted), ["id"], "word",
                                       make("id long, body string", texts), "body")
        assert rows_of(got, "id", "word") == sorted(
            {(i, n) for i, n in wanted if n and i is not None and n in (dict(texts).get(i) or "")})


def test_refreshed_views(make):
    analysis = make("owner string, mview_name string, last_refresh_date timestamp_ntz", [
        ("S", "MV_1", "2024-03-01T00:00:00"), ("S", "MV_2", "2024-03-05T00:00:00"), ("S", "MVX9", "2024-02-29T23:59:59"),
        ("S", "MV_3", "2024-03-10T08:00:01"), ("S", "MV_4", "2024-03-04T00:00:00"), ("S", "MV_", "2024-03-04T00:00:00"),
    ])
    relations = make("owner string, mview_name string, detailobj_owner string, detailobj_name string", [
        ("S", "MV_1", "V", "A"), ("S", "MV_1", "V", "B"), ("S", "MV_2", "V", "C"), ("S", "MV_4", "V", "D"),
        ("S", "MVX9", "V", "E"), ("S", "MV_3", "V", "F"), ("S", "MV_", "V", "G"),
    ])
    source = make("name string, text string", [
        ("P", "call refresh('s.mvz1')"), ("P", "S.MV_1 again"), ("Q", "S.MV_2"), ("P", "s.mvx9 s.mv_3"), ("P", None),
        ("P", "xs.mv_45 y"),
    ])
    got = lin.refreshed_views(analysis, relations, source, "P", datetime(2024, 3, 10, 8))
    # `_` stands for any character, so MV_ is found in every mention; MV_4 starts MV_45
    assert rows_of(got, "mview_name", "view_name") == [("MV_", "G"), ("MV_1", "A"), ("MV_1", "B"), ("MV_4", "D")]


@pytest.fixture(scope="module")
def catalog(make):
    long = "x" * 32760 + "A_DW.T1"
    views = make("owner string, view_name string, text string, text_length long", [
        ("V", "A", "select c1 from A_DW.T10 t", 25), ("V", "B", "select * from a_dw.t1", 21), ("V", "LONG", long, len(long)),
        ("V", "SHORTER", long[1:], len(long) - 1), ("V", "UNUSED", "A_DW.T1", 7),
    ])
    mviews = make("mview_owner string, mview_name string, view_owner string, view_name string",
                  [("M", "M1", "V", "A"), ("M", "M2", "V", "A"), ("M", "M3", "V", "B"), ("M", "M4", "V", "LONG"),
                   ("M", "M5", "V", "SHORTER")])
    tables = make("owner string, table_name string", [("A_DW", "T1"), ("A_DW", "T10"), ("B_PERIF", "T1"), ("OTHER", "T1")])
    columns = make("owner string, table_name string, column_name string",
                   [("A_DW", "T10", "c1"), ("A_DW", "T10", "C1"), ("A_DW", "T1", "t"), ("OTHER", "T1", "c1")])
    return views, mviews, tables, columns


def test_table_and_column_lineage(catalog):
    views, mviews, tables, columns = catalog
    got = lin.view_table_lineage(views, mviews, tables)
    # a longer name also holds the shorter one; case counts; long texts are read whole
    assert rows_of(got, "mview_name", "table_owner", "table_name") == [
        ("M1", "A_DW", "T1"), ("M1", "A_DW", "T10"), ("M2", "A_DW", "T1"), ("M2", "A_DW", "T10"), ("M4", "A_DW", "T1"),
        ("M5", "A_DW", "T1"),
    ]
    cols = lin.view_column_lineage(got, columns, views)
    assert rows_of(cols, "mview_name", "table_name", "col_name") == [
        ("M1", "T1", "t"), ("M1", "T10", "c1"), ("M2", "T1", "t"), ("M2", "T10", "c1"),
    ]
    assert "Python" not in plan_of(cols) and "Arrow" not in plan_of(cols)
