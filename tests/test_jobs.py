"""The submitted jobs, one after the other, over one lake."""

import json
import os
import subprocess
import sys

import pytest

from tests.conftest import tuples
from tests.test_streaming import drop_file, line
from tidemark import jobs
from tidemark.sources import lake as tables
from tidemark.sources.lake import Lake

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
AS_OF = ["--as-of", "2024-01-30T18:00:00"]


def done(capsys, *arguments):
    assert jobs.main([str(a) for a in arguments]) == 0
    return json.loads(capsys.readouterr().out.splitlines()[-1])


@pytest.mark.parametrize("kind", [[], ["--snapshots"], ["--padded"]], ids=["plain", "snapshots", "padded"])
def test_from_landing_to_mart(spark, tmp_path, capsys, kind):
    root, landing = tmp_path / "lake", str(tmp_path / "landing")
    at = ["--root", root, *kind]
    drop_file(landing, "1.json", line("a"), "no json", line("b", user_id="u2"))
    drop_file(landing, "2.json", line("c", "2024-01-30T17:00:00Z", event_type="signup"))
    flow = ["--landing", landing, "--checkpoint", tmp_path / "checkpoint", "--once"]
    got = done(capsys, "ingest", *at, *flow, "--max-bytes", "100")
    assert got == {"job": "ingest", "batches": 2, "accepted": 3, "rejected": 1}
    assert done(capsys, "ingest", *at, *flow)["batches"] == 0
    got = done(capsys, "hourly", *at, *AS_OF, "--whole-history", "--sketches")
    assert (got["silver"], got["gold_dau"], got["gold_events"], got["sketches"]) == (3, 1, 2, 2)
    assert done(capsys, "hourly", *at, *AS_OF, "--leave-out-settled")["silver"] == 3
    database = f"jobs_{len(kind)}_{(kind or ['plain'])[0].strip('-')}"
    done(capsys, "register", *at, "--database", database)
    assert spark.table(f"{database}.silver").count() == 3
    marts = database.replace("jobs", "marts")
    got = done(capsys, "mart", *at, "--mart-database", marts, "--location", tmp_path / "marts")
    assert len(got["marts"]) == 5
    assert tuples(spark.table(f"{marts}.gold_dau").select("dau")) == [(2,)]
    again = tmp_path / "again"
    done(capsys, "publish", *at, "--landing", again)
    assert spark.read.text(str(again)).count() == 3
    if "--snapshots" in kind:
        got = done(capsys, "vacuum", *at, "--keep", 1, "--older-than-hours", 0)
        assert got["gold"] == 1
        lake = Lake(str(root), snapshots=True)
        assert tables.read_silver(spark, lake).count() == 3


def test_a_failed_job_has_a_status(spark, tmp_path, capsys):
    assert jobs.main(["hourly", "--root", str(tmp_path / "none"), *AS_OF]) == 1
    assert "hourly failed" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        jobs.main(["register", "--root", str(tmp_path)])


def test_as_a_program():
    run = subprocess.run(
        [sys.executable, "-m", "tidemark.jobs", "hourly", "--help"],
        cwd=ROOT, capture_output=True, text=True, timeout=60,
    )
    assert run.returncode == 0 and "--as-of" in run.stdout
