import random

from pyspark.sql import functions as F

from starfold.functions import arrays as A

NAMES = ["a", "", "a", None, "b", "a", "c"]


def numbered(spark, array):
    df = spark.createDataFrame([(1, NAMES)], "k int, names array<string>")
    return [(r["seq"], r["item"]) for r in A.numbered(df, ["k"], array(F.col("names")), "seq").orderBy("seq").collect()]


def test_sequence_kinds(spark):
    assert numbered(spark, lambda c: c) == list(enumerate(NAMES, 1))
    assert numbered(spark, A.present) == [(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, "c")]
    assert numbered(spark, A.dense_distinct) == [(1, "a"), (2, "b"), (3, "c")]
    firsts = numbered(spark, A.first_positions)
    assert sorted((e["seq"], e["item"]) for _, e in firsts) == [(1, "a"), (5, "b"), (7, "c")]


def text_of(spark, *indexes):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(indexes)], "i int, t string")
    parsed = F.from_json("t", "map<string, array<int>>")
    return [r[0] for r in df.orderBy("i").select(A.text_from_positions(parsed)).collect()]


def test_text_from_positions(spark):
    assert text_of(
        spark, '{"b":[1],"a":[0,2]}', '{"x":[0],"y":[0,1]}', "{}", '{"a":[5],"b":[2]}', '{"a":[0],"b":[1],"a":[2]}', '{"a":null}',
    ) == ["a b a", "y y", "", "b a", "b a", ""]


def test_text_from_positions_against_a_model(spark):
    import json

    rng = random.Random(3)
    indexes, wanted = [], []
    for _ in range(200):
        index = {f"t{j}": [rng.randrange(12) for _ in range(rng.randrange(4))] for j in range(rng.randrange(7))}
        places = {}
        for token, positions in index.items():
            for p in positions:
                places[p] = token
        indexes.append(json.dumps(index))
        wanted.append(" ".join(places[p] for p in sorted(places)))
    assert text_of(spark, *indexes) == wanted
