"""What the operators leave in the folder of checkpoints."""

import os
import random

import pytest

from grapheon.llm import jaccard
from grapheon.llm.common import cut, forget
from tests.llm.test_jaccard import brute


def files(spark):
    top = spark.conf.get("spark.checkpoint.dir")
    return sum(os.path.getsize(os.path.join(d, x)) for d, _, names in os.walk(top) for x in names)


@pytest.mark.parametrize("block_sets", [1024, 8])
def test_near_duplicates_leave_no_texts(spark, block_sets):
    rng = random.Random(5)
    rows = [(i, " ".join(f"{rng.getrandbits(40):x}" for _ in range(300))) for i in range(60)]
    rows += [(1000 + 10 * i + k, f"{t} tail{k}") for i, t in rows[:40] for k in range(3)]
    base = rows[50][1]
    rows += [(5000 + k, f"h{k} {base} t{k}") for k in range(30)]  # a block of more than 8 sets
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = files(spark)
    found = jaccard.near_duplicates(df, block_sets=block_sets)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)  # its own files are still there
    assert files(spark) - before < sum(len(t) for _, t in rows) / 4


def test_forget_takes_only_the_given_frames(spark):
    a, b = cut(spark.range(1000)), cut(spark.range(2000))
    before = files(spark)
    forget(a)
    assert files(spark) < before and b.count() == 2000
    forget(a)  # a second time is no error
