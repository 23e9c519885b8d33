"""The command line, layer by layer, in processes of their own."""

import hashlib
import os
import subprocess
import sys
from pathlib import Path

from riskflow import schemas
from riskflow.plans import model
from riskflow.sources.tables import read_table
from riskflow.streaming.layers import Store

SF_DIR = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parent.parent


def call(*arguments):
    command = [sys.executable, "-m", "riskflow", *map(str, arguments)]
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS":
           "--master local[4] --conf spark.sql.shuffle.partitions=4 pyspark-shell"}
    done = subprocess.run(
        command, cwd=REPO, env=env, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-3000:]


def run_cli(*arguments, **extra):
    command = [sys.executable, "-m", "riskflow", *map(str, arguments)]
    return subprocess.run(
        command, cwd=REPO, env={**os.environ, **extra}, capture_output=True, text=True,
        timeout=300, check=False)


def test_all_layers(spark, tmp_path):
    feed, store, target = tmp_path / "feed", tmp_path / "store", tmp_path / "clustered"
    private, salt = tmp_path / "private", tmp_path / "salt"
    salt.write_text("pepper\n")
    model.write_feed(spark, SF_DIR, str(feed), broken=True)
    lookups = model.write_lookups(spark, SF_DIR, str(tmp_path / "lookups"))
    call("bronze", "--store", store, "--restricted", private, "--feed", feed, "--max-bytes", "500g",
         "--card-salt-file", salt, "--timeout", 200)
    call("silver", "--store", store, "--users", lookups["users"], "--products",
         lookups["products"], "--plans", lookups["plans"], "--ip-risk", lookups["ip_risk"],
         "--max-bytes", "500g")
    call("gold", "--store", store, "--max-bytes", "100k")
    call("dates", "--store", store, "--users", lookups["users"], "--products",
         lookups["products"], "--plans", lookups["plans"], "--ip-risk", lookups["ip_risk"],
         "--target", tmp_path / "dates", "--from-date", "2024-01-10", "--to-date", "2024-01-11")
    assert (tmp_path / "dates" / "spend").exists()
    call("compact", "--store", store, "--before", "2024-01-15")
    call("layout", "--store", store, "--target", target, "--rows-per-file", 200)
    call("layout", "--store", store, "--target", target, "--from-date", "2024-01-10",
         "--to-date", "2024-01-11")
    good = 1000 - 20 - 7  # every 50th line, and every further 75th, is corrupt
    risk = read_table(spark, Store(str(store)).table("risk"), schemas.RISK)
    assert risk.count() == good
    assert read_table(spark, str(target / "risk"), schemas.RISK).count() == good
    assert (private / "quarantine").exists() and not (store / "restricted").exists()
    row = risk.where("transaction_id = '7'").first()
    assert row.hash_card_number == hashlib.sha256(b"pepper" + b"4" + b"7".zfill(15)).hexdigest()


def test_refusals():
    for wrong, message in (
        (("--max-files", 3, "--max-bytes", "1g"), "not allowed with"),
        (("--max-bytes", "much"), "invalid"),
        ((), "--restricted is needed"),
        (("--no-quarantine", "--keep-pii"), "--restricted is needed"),
        (("--no-quarantine", "--card-salt-file", "x", "--card-salt-env", "Y"), "not allowed with"),
    ):
        done = run_cli("bronze", "--store", "s", "--feed", "f", *wrong)
        assert done.returncode == 2 and message in done.stderr
