"""Several drivers share a search: no trial is fitted twice, a dead driver's trial is taken over."""
import subprocess
import sys
import time
from pathlib import Path

import pytest

from eventcraft.plans import claims, model

WORKER = """
import sys, time
from eventcraft.plans.claims import Claims
from eventcraft.session import build_session
folder, name = sys.argv[1:]
spark = build_session("local[1]", extra={"spark.sql.warehouse.dir": folder + "/../wh-" + name})
open(folder + "/../ready-" + name, "w").close()
import os
while len([x for x in os.listdir(folder + "/..") if x.startswith("ready-")]) < 2:
    time.sleep(0.02)
c = Claims(spark, folder, name, expiry_s=60)
print(c.run([{"x": k} for k in range(12)], lambda p: time.sleep(0.1) or p["x"] / 10, poll_s=0.2))
"""


def test_two_processes_fit_no_trial_twice(spark, tmp_path):
    folder = tmp_path / "shared"
    folder.mkdir()
    root = str(Path(__file__).resolve().parents[1])
    runs = [subprocess.Popen([sys.executable, "-c", WORKER, str(folder), n], cwd=root,
                             stdout=subprocess.PIPE, text=True) for n in ("a", "b")]
    own = [eval(r.communicate(timeout=240)[0].strip().splitlines()[-1]) for r in runs]
    assert sorted(own[0] + own[1]) == list(range(12)) and own[0] and own[1]
    got = {r.trial_id: (r.score, r.worker, r.generation)
           for r in claims.ledger(spark, str(folder)).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: k / 10 for k in range(12)}
    assert {v[2] for v in got.values()} == {0}
    assert all(got[k][1] == n for n, ks in zip("ab", own, strict=True) for k in ks)


def test_dead_workers_trial_is_taken_over_and_late_results_lose_nothing(spark, tmp_path):
    folder = str(tmp_path / "shared")
    dead = claims.Claims(spark, folder, "dead", expiry_s=1.0)
    assert dead.claim(range(2)) == (0, 0)
    alive = claims.Claims(spark, folder, "alive", expiry_s=1.0)
    assert alive.claim([0]) is None
    time.sleep(1.2)
    assert alive.run([{"x": 0}, {"x": 1}], lambda p: float(p["x"]), poll_s=0.1) == [0, 1]
    rows = sorted(claims.ledger(spark, folder).collect())
    assert [(r.trial_id, r.score, r.worker, r.generation) for r in rows] == [
        (0, 0.0, "alive", 1), (1, 1.0, "alive", 0)]
    dead.finish(0, 0, {"x": 0}, 0.5)  # not dead after all: the lowest generation counts
    assert [(r.worker, r.score) for r in sorted(claims.ledger(spark, folder).collect())] == [
        ("dead", 0.5), ("alive", 1.0)]
    assert dead.claim(range(2)) is None


def test_a_long_fit_keeps_its_claim(spark, tmp_path):
    a, b = (claims.Claims(spark, str(tmp_path / "s"), n, expiry_s=1.5) for n in "ab")
    got = a.claim([7])
    with a.held(*got):
        time.sleep(2.5)
        assert b.claim([7]) is None


def test_a_failing_fit_stays_open(spark, tmp_path):
    c = claims.Claims(spark, str(tmp_path / "s"), "a", expiry_s=0)
    with pytest.raises(ZeroDivisionError):
        c.run([{}], lambda p: 1 / 0)
    assert claims.ledger(spark, str(tmp_path / "s")).count() == 0
    assert c.run([{}], lambda p: None) == [0]
    assert claims.ledger(spark, str(tmp_path / "s")).first().score is None


def test_search_by_claims_equals_the_single_ledger(spark, tmp_path):
    df = spark.range(400).selectExpr("id as row_id", "cast(id % 7 as double) as x",
                                     "cast(id % 5 as double) as z", "cast(id % 7 < 3 as int) as y")
    want = model.search(df, ["x", "z"], "y", n_trials=2, k=2)
    got = model.search(df, ["x", "z"], "y", n_trials=2, k=2, claims_folder=str(tmp_path / "c"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
