"""Shares keep what is small."""

import pytest

from opsight.functions.shares import with_share, with_share_within
from opsight.operators import workload as wl


def test_small_shares_do_not_vanish(spark):
    grouped = spark.createDataFrame([("a", "x", 400), ("a", "y", 10**9 - 400)], "side string, band string, n long")
    for df in (with_share(grouped, "n", "share"), with_share_within(grouped, ["side"], "n", "share")):
        assert {r.band: r.share for r in df.collect()} == {"x": pytest.approx(4e-7), "y": pytest.approx(1 - 4e-7)}


def test_command_shares_are_not_rounded(spark):
    log = spark.createDataFrame([(3, "a"), (2, "b"), (2, "c")], "command int, sql_id string")
    actions = spark.createDataFrame([(3, "SELECT"), (2, "INSERT")], "action int, name string")
    assert wl.command_mix(log, actions).first().share_sel == 1 / 3
