"""What an operator sends through the driver is bounded, whatever the session allows."""

import random

import pytest

from depotlens.llm import minhash
from depotlens.llm.store import BROADCAST_BYTES

from . import brute

KEY, ADAPTIVE = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.mark.parametrize("allowed, inside", [("64MB", BROADCAST_BYTES), ("1000", 1000), ("-1", -1)])
def test_near_duplicates_broadcast_small_tables_only(spark, monkeypatch, allowed, inside):
    rng = random.Random(3)
    text = brute.sentence(rng, 80, 9000)
    seen = set()

    def stored(df, name, whole=minhash.stored):
        seen.update(int(spark.conf.get(k)) for k in (KEY, ADAPTIVE))
        return whole(df, name)

    before = spark.conf.get(KEY)
    monkeypatch.setattr(minhash, "stored", stored)
    try:
        spark.conf.set(KEY, allowed)
        spark.conf.set(ADAPTIVE, allowed)
        rows = minhash.near_duplicates(brute.documents(spark, [(1, text), (2, text + " more"), (3, brute.sentence(rng, 50))])).collect()
        assert spark.conf.get(KEY) == spark.conf.get(ADAPTIVE) == allowed
    finally:
        spark.conf.set(KEY, before)
        spark.conf.unset(ADAPTIVE)
    assert seen == {inside}
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (2, 1), (3, 3)]
