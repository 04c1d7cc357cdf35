import random

import pytest
from pyspark.sql import functions as F

from quern.operators import exact, near, skew
from quern.operators.numbering import number_rows
from quern.operators.outcomes import Decisions, record_traits
from quern.operators.skew import join_groups
from quern.plans.prepare import prepare
from quern.streaming.ingest import prepare_stream


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def sequential(prints, distance):
    """The first-come rule, one row at a time."""
    kept = []
    for seq, fp in sorted(prints):
        if all(((fp ^ other) % (1 << 64)).bit_count() > distance for _, other in kept):
            kept.append((seq, fp))
    return {seq for seq, _ in kept}


def clustered(n, centers, rng, flips=6, shared_bits=0):
    """Fingerprints around few centers; the top ``shared_bits`` bits are all equal."""
    base = [rng.getrandbits(64) for _ in range(centers)]
    out = []
    for seq in rng.sample(range(10 * n), n):
        fp = rng.choice(base)
        for bit in rng.sample(range(64), rng.randint(0, flips)):
            fp ^= 1 << bit
        if shared_bits:
            fp = (fp & ((1 << (64 - shared_bits)) - 1)) | (0xABCDEF << (64 - shared_bits)) % (1 << 64)
        out.append((seq, signed(fp % (1 << 64))))
    return out


@pytest.mark.parametrize("distance, bucket_rows, shared", [(3, 512, 0), (3, 12, 0), (3, 8, 24), (6, 30, 0), (0, 2, 0)])
def test_pairs_equal_brute_force(spark, distance, bucket_rows, shared):
    rng = random.Random(distance * 100 + bucket_rows)
    rows = {fp: seq for seq, fp in clustered(400, 12, rng, shared_bits=shared)}
    prints = [(seq, fp) for fp, seq in rows.items()]
    want = {
        (min(a, b), max(a, b), ((x ^ y) % (1 << 64)).bit_count())
        for i, (a, x) in enumerate(prints)
        for b, y in prints[:i]
        if ((x ^ y) % (1 << 64)).bit_count() <= distance
    }
    df = spark.createDataFrame(prints, "seq long, fp long")
    got = [tuple(r) for r in near.near_dup_pairs(df, distance, bucket_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_all_buckets_crowded_without_lookup(spark, monkeypatch):
    monkeypatch.setattr(near, "MAX_CROWDED", 0)
    prints = clustered(200, 6, random.Random(5))
    rows = list({fp: (seq, fp) for seq, fp in prints}.values())
    df = spark.createDataFrame(rows, "seq long, fp long")
    a = near.near_dup_pairs(df, 3, 4).collect()
    monkeypatch.undo()
    assert sorted(map(tuple, a)) == sorted(map(tuple, near.near_dup_pairs(df, 3).collect()))


@pytest.mark.parametrize("seed, distance", [(1, 3), (2, 3), (3, 8)])
def test_greedy_equals_sequential(spark, seed, distance):
    prints = clustered(300, 10, random.Random(seed))
    df = spark.createDataFrame(prints, "seq long, fp long")
    got = {r.seq for r in near.near_dedup_greedy(df, distance, 16).collect()}
    assert got == sequential(prints, distance)


def test_long_chain(spark):
    """Each print is near its neighbours only: every other one is kept."""
    prints = [(i, signed(((1 << (3 * i)) - 1) % (1 << 64))) for i in range(21)]
    df = spark.createDataFrame(prints, "seq long, fp long")
    got = {r.seq for r in near.near_dedup_greedy(df).collect()}
    assert got == sequential(prints, 3) == set(range(0, 21, 2))


def test_distance_is_checked(spark):
    with pytest.raises(ValueError):
        near.near_dup_pairs(spark.createDataFrame([], "seq long, fp long"), 64)


def test_hot_keys_join_in_two_ways(spark):
    rows = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k")
    )
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    plain = rows.join(groups, "k")
    split = join_groups(rows, groups, "k", "n", hot_rows=100, max_keys=3)
    assert split.count() == 1000
    everywhere = join_groups(rows, groups, "k", "n")
    assert everywhere.exceptAll(plain.select(*everywhere.columns)).isEmpty()
    assert split.exceptAll(plain.select(*split.columns)).isEmpty()


def test_number_rows_is_dense_and_ordered(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.hash("id")).alias("h"), "id")
    got = number_rows(rows, ["h", "id"], "n", start=10).collect()
    assert sorted(r.n for r in got) == list(range(10, 5010))
    by_n = sorted(got, key=lambda r: r.n)
    assert [(r.h, r.id) for r in by_n] == sorted((r.h, r.id) for r in got)


A = "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn every single day"


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def statuses(decisions):
    return [r.status for r in sorted(decisions.outcomes().collect(), key=lambda r: r.seq)]


def test_statuses_and_stats(spark):
    data = docs(spark, "short", A, A + " ", None, "да нет " * 20, "или так " * 20, A)
    decisions = Decisions(record_traits(data, "doc_id"))
    assert statuses(decisions) == [
        "short",
        "kept",
        "exact_duplicate",
        "invalid",
        "kept",
        "near_duplicate",
        "exact_duplicate",
    ]
    stats = decisions.stats().first().asDict()
    assert stats == {
        "read": 7,
        "invalid": 1,
        "short": 1,
        "exact_duplicate": 2,
        "near_duplicate": 1,
        "kept": 2,
    }


def test_repeat_of_a_near_duplicate_is_near_again(spark):
    """Texts without tokens share fingerprint 0; only the first is kept and remembered."""
    first, second = "да нет " * 20, "или так " * 20
    decisions = Decisions(record_traits(docs(spark, first, second, second, first), "doc_id"))
    assert statuses(decisions) == ["kept", "near_duplicate", "near_duplicate", "exact_duplicate"]
    assert [r.status for r in sorted(decisions.outcomes(hot_rows=1).collect())] == statuses(decisions)


def test_result_does_not_depend_on_partitions(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = prepare(table.repartition(13)).kept
    b = prepare(table.coalesce(1)).kept
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# Counts found by an independent sequential run.
@pytest.mark.parametrize(
    "sf, family, counts",
    [
        ("0.001", "blake2b", [200, 0, 7, 10, 0, 183]),
        ("0.01", "blake2b", [1000, 0, 14, 72, 1, 913]),
        ("0.1", "blake2b", [10000, 0, 224, 685, 6, 9085]),
        ("0.1", "md5", [10000, 0, 224, 685, 3, 9088]),
    ],
)
def test_known_counts(spark, sf, family, counts):
    table = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    assert list(prepare(table, family=family).stats.first()) == counts


def test_empty_input(spark):
    result = prepare(docs(spark).limit(0))
    assert list(result.stats.first()) == [0] * 6
    assert result.kept.isEmpty() and result.outcomes.isEmpty()


def test_exact_dedup_keeps_the_first(spark):
    data = docs(spark, "  tiny ", " some longer text here ", "some longer text here", "another long text!")
    kept = exact.exact_dedup_text(data).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "some longer text here"), (3, "another long text!")]


def test_dense_bucket_is_compared_in_cells(spark, monkeypatch):
    """A cluster that splitting cannot thin out, in cells of about eight rows a side."""
    rng = random.Random(11)
    rows = {fp: seq for seq, fp in clustered(300, 1, rng, flips=3)}
    prints = [(seq, fp) for fp, seq in rows.items()]
    df = spark.createDataFrame(prints, "seq long, fp long")
    want = sorted(map(tuple, near.near_dup_pairs(df, 3, 10_000).collect()))
    monkeypatch.setattr(near, "CELL_ROWS", 8)
    monkeypatch.setattr(near, "MAX_LEVELS", 1)
    assert sorted(map(tuple, near.near_dup_pairs(df, 3, 60).collect())) == want and want


def test_stream_equals_batch(spark, tmp_path):
    near_a, near_b = "да нет " * 20, "или так " * 20
    texts = [A, "short", A, near_a, None, near_b, A, near_a, near_b, A + " once more and again", "x" * 90]
    data = docs(spark, *texts)
    for low, high in [(0, 4), (4, 7), (7, 11)]:
        span = data.where((F.col("doc_id") >= low) & (F.col("doc_id") < high))
        span.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    folders = [f"{tmp_path}/{name}" for name in ("out", "state", "checkpoint")]
    prepare_stream(stream, *folders).awaitTermination()
    got = spark.read.schema(data.schema).parquet(folders[0]).select("doc_id", "text")
    want = prepare(data).kept.select("doc_id", "text")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert want.count() == 4


def test_known_texts_count_as_seen(spark):
    first = Decisions(record_traits(docs(spark, A, "да нет " * 20), "doc_id"))
    later = docs(spark, None, None, A, "или так " * 20, A, "y" * 90).where("doc_id > 1")
    decisions = Decisions(record_traits(later, "doc_id"), known=first.kept_texts())
    assert statuses(decisions) == ["exact_duplicate", "near_duplicate", "exact_duplicate", "kept"]
    assert list(decisions.stats().first()) == [4, 0, 0, 2, 1, 1]


@pytest.mark.parametrize("bucket_rows", [512, 8])
def test_known_fingerprints_are_never_paired_with_each_other(spark, bucket_rows):
    rows = list({fp: seq for seq, fp in clustered(300, 8, random.Random(77))}.items())
    rows = sorted((seq, fp) for fp, seq in rows)
    cut = len(rows) // 2
    known, given = rows[:cut], rows[cut:]
    want = {
        (a, b)
        for i, (b, y) in enumerate(rows)
        for a, x in rows[:i]
        if i >= cut and ((x ^ y) % (1 << 64)).bit_count() <= 3
    }
    frames = [spark.createDataFrame(part, "seq long, fp long") for part in (given, known)]
    pairs = near.near_dup_pairs(frames[0], 3, bucket_rows, known=frames[1]).collect()
    assert {(r.a, r.b) for r in pairs} == want and len(pairs) == len(want)


def test_rows_near_known_survivors_do_not_survive(spark):
    rows = sorted((seq, fp) for seq, fp in clustered(300, 8, random.Random(78)))
    cut = len(rows) // 2
    before = sequential(rows[:cut], 3)
    known = spark.createDataFrame([r for r in rows[:cut] if r[0] in before], "seq long, fp long")
    given = spark.createDataFrame(rows[cut:], "seq long, fp long")
    got = {r.seq for r in near.near_dedup_greedy(given, known=known).collect()}
    assert got == sequential(rows, 3) - before
    none = spark.createDataFrame([], "seq long, fp long")
    assert {r.seq for r in near.near_dedup_greedy(given, known=none).collect()} == sequential(rows[cut:], 3)


def test_heavy_key_rows_are_joined_without_broadcasting_them(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_BROADCAST_BYTES", 10)
    rows = [(i, "hot" if i % 3 else f"k{i % 7}", "x") for i in range(300)] + [(0, "k0", "x")] * 5
    sizes = {}
    for _, key, _ in rows:
        sizes[key] = sizes.get(key, 0) + 1
    left = spark.createDataFrame(rows, "id long, key string, `a.b` string")
    groups = spark.createDataFrame([(k, n, k * 3) for k, n in sizes.items()], "key string, n long, rules string")
    joined = join_groups(left, groups, "key", "n", hot_rows=20, weight=F.lit(1000))
    got = sorted((r.id, r.key, r.rules) for r in joined.collect())
    assert got == sorted((i, k, k * 3) for i, k, _ in rows)
