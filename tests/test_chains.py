import random

import pytest

from rowkin.operators import chains, names
from rowkin.scratch import store
from rowkin.settings import MatchSettings


def greedy(pairs):
    """Records beaten by an earlier unique one, taken in order."""
    earlier, beaten = {}, set()
    for i, j in pairs:
        earlier.setdefault(i, set()).add(j)
    for i in sorted(earlier):
        if any(j not in beaten for j in earlier[i]):
            beaten.add(i)
    return sorted(beaten)


def beaten_of(spark, pairs, settings=MatchSettings(), parts=4):
    df = store(spark.createDataFrame(pairs, "i bigint, j bigint").repartition(parts), "pairs")
    return sorted(r["id"] for r in names._eliminate(df, settings).collect())


@pytest.fixture
def uncoalesced(spark):
    """Small tables spread over as many ranges as there are partitions, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed, density", [(1, 0.02), (2, 0.1), (3, 0.5)])
def test_any_pairs_over_several_ranges(spark, uncoalesced, seed, density):
    rng = random.Random(seed)
    ids = sorted(rng.sample(range(10_000), 90))
    pairs = [(i, j) for n, i in enumerate(ids) for j in ids[:n] if rng.random() < density]
    assert beaten_of(spark, pairs, MatchSettings(hot_rows=3, hot_keys=5)) == greedy(pairs)


def test_a_ladder_and_a_star(spark, uncoalesced):
    """Records with two earlier partners each, and many with the same one."""
    ladder = [(i, j) for i in range(1, 120) for j in (i - 1, i - 2) if j >= 0]
    star = [(i, 500) for i in range(501, 900)] + [(500, 499)]
    assert beaten_of(spark, ladder + star) == greedy(ladder + star)


def test_a_long_chain_takes_few_jobs(spark):
    """A thousand names that each hang on the one before: one set of jobs per link would be thousands."""
    pairs = [(i, i - 1) for i in range(1, 1000)]
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        assert beaten_of(spark, pairs) == list(range(1, 1000, 2))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) <= 30


def test_a_chain_across_ranges_is_contracted(spark, uncoalesced):
    """Links that alternate between far ranges: nothing is settled inside one, so pointers double."""
    rng = random.Random(7)
    order = list(range(0, 4000, 10))
    pairs = list(zip(order[1:], order))
    rng.shuffle(pairs)
    assert beaten_of(spark, pairs) == greedy(pairs)
    # Ids in a chain always ascend, so each range passes its end on; a round settles them all.
    told = chains.fates(store(spark.createDataFrame(pairs, "i bigint, j bigint"), "pairs"))
    assert told.figures["open"] == 0 and told.figures["links"] == len(pairs)


def test_no_pairs(spark):
    assert beaten_of(spark, []) == []
