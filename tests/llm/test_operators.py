"""What the operators give beyond the contracts: verdicts, mixes, added spans, random access, odd tables."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.llm import exact_dedup, mixing, pii, quality, secrets, sentencepiece_bpe, token_files
from chorale.llm.queries import QUERIES
from chorale.session import scratch_dir

ODD = "doc_id bigint, text string, source string, lang string, key string, n int, size int, keep_id int, kept boolean, word string, base int"


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, ties, null columns, and columns named like those the operators make."""
    text = "alpha beta gamma delta " * 30
    rows = [(None, text), (None, text), (1, text), (1, text), (2, None), (2, None), (3, ""), (4, text.upper()), (5, "other words " * 40)]
    return spark.createDataFrame([(i, t, None if i == 3 else "s", None, "k", 1, 2, 3, True, "w", 4) for i, t in rows], ODD)


# ---- exact dedup

def test_one_row_of_each_text_stays(odd):
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()), key=str) == sorted([(4, "ALPHA"), (3, ""), (5, "other")], key=str)
    found = exact_dedup.exact_duplicates(odd)
    assert found.count() == 9 and found.filter("kept").count() == 3
    assert {r["group_size"] for r in found.filter("doc_id IS NULL").collect()} == {5}


def test_directory_splits_overfull_buckets(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 3000).cast("string")).alias("text"))
    found = exact_dedup.exact_duplicates(docs, capacity=50)
    keys = found.select("bucket_depth", "bucket", "text_sha256").distinct().groupBy("bucket_depth", "bucket").count()
    assert keys.filter("count > 50").count() == 0 and keys.count() > 60
    assert found.select("bucket_depth").distinct().count() > 1, "buckets have depths of their own"
    # A bucket is the leading bits of its keys: no bucket lies inside another.
    spans = sorted((r["bucket"] << (12 - r["bucket_depth"]), (r["bucket"] + 1) << (12 - r["bucket_depth"])) for r in keys.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


# ---- quality

def test_trees_learn_and_keep_their_directions():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 3))
    y = ((x[:, 0] - np.abs(x[:, 1]) + 0.3 * r.normal(size=4000)) > 0).astype(float)
    trees = quality.fit_trees(x[:3000], y[:3000], [1, 0, -1])
    assert ((trees.score(x[3000:]) > 0) == (y[3000:] > 0)).mean() > 0.9
    probe = np.repeat(r.normal(size=(50, 3)), 40, axis=0)
    for feature, sign in ((0, 1), (2, -1)):
        line = probe.copy()
        line[:, feature] = np.tile(np.linspace(-3, 3, 40), 50)
        assert (sign * np.diff(trees.score(line).reshape(50, 40), axis=1) >= -1e-12).all()


def test_flat_nodes_score_like_a_walk():
    r = np.random.default_rng(2)
    x, y = r.normal(size=(500, 4)), (r.random(500) > 0.4).astype(float)
    t = quality.fit_trees(x, y, [0, 0, 0, 0], n_trees=5)

    def walk(row):
        total = t.base
        for at in t.roots:
            while t.left[at] != at:
                at = t.left[at] if row[t.feature[at]] <= t.threshold[at] else t.right[at]
            total += t.value[at]
        return total

    assert np.allclose(t.score(x), [walk(row) for row in x])


def test_verdicts_on_documents_not_seen(spark):
    """Fitted on the labels of the smaller tables, judged by those of larger ones."""
    small, large = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
    read = lambda d, n: spark.read.parquet(f"{d}/{n}.parquet")
    docs = read(large, "documents").filter("doc_id >= 1000")
    trees = quality.fit_quality(read(small, "documents"), read(small, "labels"))
    found = quality.document_statistics(docs).join(read(large, "labels"), "doc_id").toPandas()
    found = found[~quality.failed(found["n_words"].to_numpy(), found["n_repeat_words"].to_numpy())]
    kept, good = trees.score(found[list(quality.FEATURES)].to_numpy(float)) >= 0, found["quality"].to_numpy() == 1
    assert (kept == good).mean() > 0.97 and kept[good].mean() > 0.99 and len(found) > 2000


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(None, 0), (5, None)]])
def test_without_labels_of_both_kinds_the_model_keeps_all(spark, odd, labels):
    df = spark.createDataFrame(labels, "doc_id bigint, quality int")
    found = quality.judge(odd, df)
    assert found.filter("kept <> (NOT base_failed)").count() == 0 and found.count() == odd.count()
    assert quality.keep_good(odd, df).columns == odd.columns


# ---- mixing

def check_mix(found, docs):
    targets = brute.targets(docs)
    size = {}
    for r in found:
        source_size, target = targets[r["source"]]
        assert r["source_size"] == source_size and r["target"] == pytest.approx(target, rel=1e-9)
        assert r["taken"] % max(r["size"], 1) == 0 and 0 <= r["taken"] <= 2 * r["size"]
        size[r["source"]] = size.get(r["source"], 0) + r["taken"]
    return {s: (targets[s][1], size[s]) for s in size}


def test_mix_of_small_tables(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "source")
    found = QUERIES["op10_mixing"](spark, d).collect()
    for target, taken in check_mix(found, [tuple(r) for r in docs.collect()]).values():
        assert taken == int(target), "the knapsack fills the budget to the word"
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in found)


def test_mix_of_odd_tables(spark, odd, edge_docs):
    for df in (odd, edge_docs):
        found = mixing.mix(df).collect()
        assert len(found) == df.count()
        check_mix(found, [tuple(r) for r in df.select("doc_id", "text", "source").collect()])
    assert mixing.mix(odd.limit(0)).count() == 0
    taken = mixing.take_mixed(edge_docs)
    assert taken.columns == edge_docs.columns
    want = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(edge_docs).collect() if r["copies"]})
    assert Counter(r["doc_id"] for r in taken.collect()) == want


def test_slices_take_exactly_what_the_plan_says(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 7)
    docs = spark.range(3000).select("id", F.concat(F.lit("w "), F.expr("repeat('x ', id % 3)")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source")).withColumnRenamed("id", "doc_id")
    found = mixing.mix(docs).collect()
    for target, taken in check_mix(found, [tuple(r) for r in docs.collect()]).values():
        assert taken == int(target)


@pytest.mark.parametrize("seed", range(6))
def test_knapsack_against_all_sums(seed):
    r = random.Random(seed)
    lengths = sorted(r.sample(range(1, 40), 5))
    counts = [r.randint(1, 4) for _ in lengths]
    sums = {0}
    for n, c in zip(lengths, counts):
        sums = {s + k * n for s in sums for k in range(c + 1)}
    for budget in range(0, 120, 7):
        used = mixing._knapsack(np.array(lengths), np.array(counts), budget)
        assert (used <= counts).all() and used @ np.array(lengths) == max(s for s in sums if s <= budget)


# ---- secrets and personal data

def test_random_strings_are_added_and_plain_ones_are_not(spark):
    r = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(r.choice(letters) for _ in range(32)) for _ in range(60)]
    plain = ["aaaa1111" * 4, "abcabcabc123123123abcabc", "zz00" * 9, "version-1-1-1-1-1-1-1-1-1-1-1", "a" * 30 + "12"]
    docs = spark.createDataFrame([(i, f"see {k} there") for i, k in enumerate(keys + plain)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["spans"] for r in secrets.digests(secrets.find_secrets(docs)).collect()}
    assert sum(found[i] == "random:4:36" for i in range(60)) >= 59
    assert all("random" not in found[60 + i] for i in range(len(plain)))


def test_random_letters_are_told_from_words(spark):
    """Keys with few digits or none are found; the long words of the table's documents are not."""
    r = random.Random(14)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    make = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    keys = [make(letters, n) for letters in (upper, lower, upper + lower, upper + lower + digits) for n in (16, 20, 24, 32) for _ in range(25)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10 ** 6 + i, f"see {k} there") for i, k in enumerate(keys)], docs.schema))
    found = secrets.find_secrets(docs).select("doc_id", F.transform("added", lambda s: s["value"]).alias("added"), F.transform(
        "tested", lambda t: t["span"]["value"]).alias("tested")).collect()
    assert sum(x["added"] == [keys[x["doc_id"] - 10 ** 6]] for x in found if x["doc_id"] >= 10 ** 6) >= 0.97 * len(keys)
    words, flagged = ([w for x in found if x["doc_id"] < 10 ** 6 for w in x[c] if w.isalpha()] for c in ("tested", "added"))
    assert len(words) > 100 and len(flagged) <= 0.05 * len(words)


def test_false_discovery_threshold():
    assert secrets.rejected_from({0: 100}, 0.01) == secrets.LAST_BIN + 1
    assert secrets.rejected_from({0: 90, 300: 10}, 0.01) <= 300
    assert secrets.rejected_from({0: 50, 35: 50}, 0.01) == 35 and secrets.rejected_from({}, 0.01) == secrets.LAST_BIN + 1


def test_disclosing_terms_are_generalised(spark):
    """A name that stands by an address in several texts, and nowhere else, tells who it is; common words do not."""
    r = random.Random(5)
    filler = lambda: " ".join(r.choice(["one", "two", "three", "four", "Five", "six7", "7"]) for _ in range(12))
    rows = [(i, f"{filler()}\nwrite to Zebulon x@y.org today two {filler()}") for i in range(6)]
    rows += [(10 + i, f"{filler()} today write to {filler()}") for i in range(200)]
    rows += [(300 + i, "just one text Solo z@y.org here") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in pii.find_personal(docs).collect()}
    for i in range(6):
        text = rows[i][1]
        assert [text[s["start"]:s["end"]] for s in found[i]["added"]] == ["Zebulon"]
        assert [s["value"] for s in found[i]["added"]] == ["[NAME]"]
    assert all(not r["added"] for i, r in found.items() if i >= 10), "one text in many copies is no evidence"
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[0] == rows[0][1].replace("Zebulon", "[NAME]").replace("x@y.org", "[EMAIL]") and clean[12] == rows[8][1]


def test_disclosing_terms_at_any_distance(spark):
    """A name on another line than the address, more than 400 characters away, is found, and replaced wherever it stands
    in the documents that hold the address."""
    r = random.Random(15)
    filler = lambda: " ".join(r.choice(["one", "two", "three", "four", "Five", "six7", "7"]) for _ in range(200))
    rows = [(i, f"Zebulon {filler()}\n\n{filler()} Zebulon two three four\n\n{filler()}\nx@y.org\n{filler()} Zebulon") for i in range(6)]
    rows += [(10 + i, filler()) for i in range(200)]
    docs = spark.createDataFrame([*rows, (300, "Zebulon")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in pii.find_personal(docs).collect()}
    for i, text in rows[:6]:
        assert sorted(text[s["start"]:s["end"]] for s in found[i]["added"]) == ["Zebulon"] * 3
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[0] == rows[0][1].replace("Zebulon", "[NAME]").replace("x@y.org", "[EMAIL]")
    assert clean[300] == "Zebulon", "documents that do not hold the entity stay as they are"


@pytest.mark.parametrize("n", [0, 9])
def test_odd_tables(spark, odd, n):
    """Every operator takes null ids, repeated rows, clashing columns and no rows at all."""
    df = odd.limit(n)
    for f in (lambda d: secrets.digests(secrets.find_secrets(d)), lambda d: pii.digests(pii.find_personal(d)), pii.sanitise,
              lambda d: sentencepiece_bpe.digests(sentencepiece_bpe.encode(d)), token_files.token_files, exact_dedup.exact_duplicates,
              quality.document_statistics):
        assert f(df).count() == n


# ---- token files

def test_random_access_reads_any_range(spark, edge_docs, edge_rows):
    path = scratch_dir(spark, "ranges")
    token_files.write_token_files(edge_docs, path, shard_ids=500)
    assert spark.read.parquet(path).count() > 5
    whole = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_files.read_token_files(spark, path).collect()}
    r = random.Random(6)
    asked = [(d, a, a + r.randint(0, 30)) for d, ids in whole.items() for a in (0, r.randint(0, len(ids)), max(0, len(ids) - 3))]
    wanted = spark.createDataFrame(asked, "doc_id bigint, from_id bigint, to_id bigint")
    found = token_files.read_ranges(spark, path, wanted).collect()
    assert len(found) == len(asked)
    for f in found:
        assert f["ids"] == whole[f["doc_id"]][f["from_id"]:f["to_id"]]


def test_grammar_round_trip_and_rules():
    r = random.Random(8)
    for alphabet in (1, 2, 5, 300):
        ids = np.array([r.randrange(alphabet) for _ in range(6000)], dtype=np.uint32)
        lengths = np.array([1000, 1, 2999, 2000])
        rules, sizes, seq, symbols = token_files.compress(ids, lengths, 300)
        assert (token_files.expand(seq, rules, 300) == ids).all() and symbols.sum() == len(seq)
        assert (token_files.expand_shard(seq, rules, sizes, 300) == ids).all()
        stops = np.cumsum(symbols)
        for k, n in enumerate(lengths):
            assert len(token_files.expand(seq[stops[k] - symbols[k]:stops[k]], rules, 300)) == n, "pairs never cross documents"
        assert all(len(token_files.expand(np.array([300 + i]), rules, 300)) == s for i, s in enumerate(sizes.tolist()))
        if alphabet < 10:
            assert len(seq) < len(ids) / 2 and len(token_files.compress(ids, lengths, 300)[0]) == len(rules)
