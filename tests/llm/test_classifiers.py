"""Language ID, toxicity and URL filters."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rowkin.llm import nnpu_toxicity as N
from rowkin.llm import rank_language as R
from rowkin.llm import url_logistic as U
from rowkin.llm.queries import op6_language, op10_toxicity, table

SMALL = "/root/testdata/sf0.01"


def _plain_counts(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        out.update(word)
        padded = f" {word} "
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return out


def _code(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def test_gram_counts_against_plain_python(monkeypatch):
    rng = random.Random(1)
    texts = ["", "a", "1 2", "İstanbul ẞ", "don't!!", "日本 語", "😀 x".encode("utf-16", "surrogatepass").decode("utf-16")]
    texts += ["".join(rng.choice("abé 1\n") for _ in range(rng.randint(1, 90))) for _ in range(200)]
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(R, "CHUNK", chunk)
        for text in texts:
            keys, counts = R.gram_counts(text)
            assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == {_code(g): n for g, n in _plain_counts(text).items()}, text


def test_distance_against_plain_python():
    profiles = {"x": [_code(g) for g in ("a", "b", " a", "ab")], "y": [_code(g) for g in ("c", "b", "a")]}
    own = R.ranked(*R.gram_counts("ab ab a"), 4)
    expected = {}
    for lang, theirs in profiles.items():
        expected[lang] = sum(min(abs(theirs.index(g) - k), 4) if g in theirs else 4 for k, g in enumerate(own.tolist()))
    best = min(sorted(expected), key=expected.get)
    found = R.nearest(own, *R._table(profiles, 4), 4)
    assert found == (best, 1 - expected[best] / (4 * len(own)))


def test_language_of_held_out_documents(spark):
    rows = op6_language(spark, SMALL).join(table(spark, SMALL, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(spark):
    docs = spark.createDataFrame([(1, "the cat", "en"), (2, None, "en"), (3, "12 !", None), (3, "das ist", "de"), (None, "", "fr")], "doc_id long, text string, lang string")
    found = sorted(((r["doc_id"] or 0, r["lang_pred"]) for r in R.identify(docs, R.learn(docs)).collect()))
    assert found == [(0, "und"), (1, "en"), (2, "und"), (3, "de"), (3, "und")]
    nothing = R.learn(docs.limit(0))
    assert nothing == {} and {r["lang_pred"] for r in R.identify(docs, nothing).collect()} == {"und"}
    assert R.identify(docs.limit(0), R.learn(docs)).collect() == []


def test_toxicity_of_held_out_documents(spark):
    labels = table(spark, SMALL, "labels")
    rows = op10_toxicity(spark, SMALL).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hit / sum(r["toxic"] == 1 for r in rows) > 0.6
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(clean) / len(clean) < 0.05


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = " ".join(f"wört{i}x idiot" for i in range(200))
    whole = N.text_features(text)
    monkeypatch.setattr(N, "CHUNK", 50)
    assert np.array_equal(N.text_features(text), whole)
    assert len(N.text_features(None)) == len(N.text_features("12 ..")) == 0


def test_fit_separates_and_handles_missing_classes():
    rng = np.random.default_rng(1)
    clean = [np.unique(rng.integers(1000, 3000, 40)) for _ in range(300)]
    toxic = [np.unique(np.r_[rng.integers(1000, 3000, 40), rng.choice([1, 2, 3], 2)]) for _ in range(120)]
    model = N.fit(toxic[:80], clean[:200] + toxic[80:100], 0.1)
    assert np.mean([model.score(x) >= 0.5 for x in toxic[100:]]) > 0.9
    assert np.mean([model.score(x) >= 0.5 for x in clean[200:]]) < 0.05
    assert abs(N.fit([], clean, 0.1).score(clean[0]) - 0.1) < 1e-9


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, "idiot"), (1, None), (None, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (2, 1)], "doc_id long, toxic int")
    model = N.train(docs, labels)
    assert [0 <= r["score"] <= 1 for r in N.scored(docs, model).collect()] == [True] * 3
    assert N.scored(docs.limit(0), N.train(docs, labels.limit(0))).collect() == []


def _parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    return host.lower() if host.isascii() else host, rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]


def test_url_parts_rules_and_verdicts(spark):
    urls = [
        "https://www.Example.com/en/x?y", "http://example.com/en/", "http://example.com/en", "http://a.com", "http://a.com/", "http://com/x",
        "http://xcom/", "http://a.net/es/1", "http://net/fr/", "http://a.b/?u=http://c.com/", "no scheme", "", None, "http://", "http://h#f", "http://a.com?q=/x",
        "http://casino-win.org/en/1", "http://river.org/en/1",
    ]
    pages = spark.createDataFrame([(i, u, "p") for i, u in enumerate(urls)], "page_id long, url string, host string")
    model = U.train(U.labelled_table(spark))
    rows = {r["page_id"]: r for r in U.judged(pages, model).collect()}
    rules = [(h, p, "allow") for h, p in U.ALLOW] + [(h, p, "block") for h, p in U.BLOCK]
    for i, url in enumerate(urls):
        host, path = _parts(url)
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rows[i]["host"], rows[i]["path"]) == (host, path), url
        assert rows[i]["rule"] == (max(fits)[1] if fits else None)
        if fits:
            assert rows[i]["verdict"] == max(fits)[2]
    assert rows[16]["verdict"] == "block" and rows[17]["verdict"] == "allow"
    assert {r["verdict"] for r in rows.values()} == {"allow", "block"}
    assert U.judged(pages.limit(0), model).collect() == []
    assert U.train(U.labelled_table(spark).limit(0))[1] < 0


def test_url_score_is_that_of_the_weights(spark):
    weights = [float(k % 7 - 3) / 4 for k in range(U.BUCKETS)]
    pages = spark.createDataFrame([(1, "http://ab.c/d1e")], "page_id long, url string")
    host, path = U.host_and_path(pages["url"])
    features = pages.select(U.buckets(host, path)).first()[0]
    z = 0.5 + sum(weights[b] for b in features) / len(features) ** 0.5
    assert abs(U.judged(pages, (weights, 0.5)).first()["score"] - 1 / (1 + np.exp(-z))) < 1e-12


def test_fitting_sample_holds_2000_positive_and_5000_unlabelled_texts(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(N, "fit", lambda positive, unlabelled, prior: sizes.append((len(positive), len(unlabelled))))
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = spark.range(2500).selectExpr("id as doc_id", "cast(id < 2000 as int) as toxic")
    N.train(docs, labels)
    assert sizes == [(2000, 5000)]


def test_toxicity_sample_is_bounded_by_rows_and_characters(spark, monkeypatch):
    rows = [(1, f"vile text {i}") for i in range(20_000)] + [(1, "vile text 0")] * 50 + [(i, f"fine text {i}") for i in range(2, 400)] + [(None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("positive", F.lit("mine")).withColumn("id", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(N, "fit", lambda p, u, prior: seen.append((len(p), len(u), prior)))
    monkeypatch.setattr(N, "MOST_POSITIVE", 100)
    monkeypatch.setattr(N, "MOST_UNLABELLED", 300)
    N.train(docs.select("doc_id", "text", "positive", "id"), labels)
    assert seen[0][0] == 100 and 0 < seen[0][1] <= 300 and seen[0][2] == 0.5
    monkeypatch.setattr(N, "MOST_CHARS", 60)
    N.train(docs, labels)
    assert 0 < seen[1][0] <= 7 and 0 < seen[1][1] <= 7


def _plain_features(text):
    """Distinct grams of lower-cased words between blanks, spelled out."""
    out = set()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        padded = f" {word} "
        for n in N.GRAMS:
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


def test_toxicity_features_and_fit_against_plain_python():
    texts = [r for r in ("the vile idiot", "idiot of the moors", "a b", "", None, "Vile VILE vile", "x1y2 idiots!")]
    assert [len(N.text_features(t)) for t in texts] == [len(_plain_features(t)) for t in texts]
    shared = {(a, b): len(np.intersect1d(N.text_features(a), N.text_features(b))) for a in texts for b in texts}
    assert shared == {(a, b): len(_plain_features(a) & _plain_features(b)) for a in texts for b in texts}

    rng = np.random.default_rng(3)
    positives = [np.unique(np.r_[rng.integers(100, 160, 9), rng.choice([1, 2, 3, 4], 2)]) for _ in range(60)]
    unlabelled = [np.unique(rng.integers(100, 160, 10)) for _ in range(240)] + positives[:9]
    prior, steps, rate = 0.1, 25, 0.05
    model = N.fit(positives, unlabelled, prior, steps, rate)
    assert list(model.keys) == [1, 2, 3, 4]
    # The same risk and the same steps, one text and one feature at a time; copies count once.
    pos = [[float(f in set(x)) for f in model.keys] for x in {x.tobytes(): x for x in positives}.values()]
    unl = [[float(f in set(x)) for f in model.keys] for x in {x.tobytes(): x for x in unlabelled}.values()]
    par = [0.0] * len(model.keys) + [math.log(prior / (1 - prior))]
    first, second = [0.0] * len(par), [0.0] * len(par)

    def mean_slope(rows, shift):
        out = [0.0] * len(par)
        for row in rows:
            z = sum(w * x for w, x in zip(par, row, strict=False)) + par[-1]
            for k, x in enumerate([*row, 1.0]):
                out[k] += (1 / (1 + math.exp(-z)) - shift) * x / len(rows)
        return out

    def mean_loss(rows):
        return sum(math.log1p(math.exp(sum(w * x for w, x in zip(par, r, strict=False)) + par[-1])) for r in rows) / len(rows)

    for step in range(1, steps + 1):
        negative = mean_loss(unl) - prior * mean_loss(pos)
        u, p, q = mean_slope(unl, 0), mean_slope(pos, 0), mean_slope(pos, 1)
        for k in range(len(par)):
            g = prior * q[k] + u[k] - prior * p[k] if negative >= 0 else -N.BACK * (u[k] - prior * p[k])
            g += N.DECAY * par[k] if k < len(par) - 1 else 0
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
        for k in range(len(par)):
            par[k] -= rate * (first[k] / (1 - 0.9**step)) / (math.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    assert np.allclose([*model.weights, model.bias], par, atol=1e-6)


def test_url_training_against_numpy(spark):
    urls = U.labelled_urls()[::7]
    table = spark.createDataFrame([*urls, (None, 1), ("http://x.test/", None), urls[0]], "url string, label int")
    weights, bias = U.train(table, steps=6, rate=2.0)
    host, path = U.host_and_path(F.col("url"))
    rows = table.dropna().select(U.buckets(host, path).alias("f"), "label").collect()
    x = np.zeros((len(rows), U.BUCKETS))
    for row, found in zip(x, rows, strict=True):
        row[found["f"]] = 1 / np.sqrt(len(found["f"]))
    y = np.array([r["label"] for r in rows])
    at = ahead = np.zeros(U.BUCKETS)
    for _ in range(6):
        off = 1 / (1 + np.exp(-(U.BIAS + x @ ahead))) - y
        new = ahead - 2.0 / len(rows) * (x.T @ off)
        at, ahead = new, new + U.MOMENTUM * (new - at)
    assert bias == U.BIAS and np.allclose(weights, at, atol=1e-12)


def test_url_hosts_and_paths_held_out(spark):
    assert sorted(map(tuple, U.labelled_table(spark).collect())) == sorted(U.labelled_urls())

    # Every fourth host and every fourth bad path is kept from the training.
    bad, good, paths = U.BAD_HOSTS[::4], U.GOOD_HOSTS[::4], U.BAD_PATHS[::4]
    gone = re.compile(r"[/.](" + "|".join((*bad, *good)) + r")\.test|(" + "|".join(map(re.escape, paths)) + ")$")
    table = [(u, y) for u, y in U.labelled_urls() if not gone.search(u)]
    assert 100 < len(table) < len(U.labelled_urls())
    model = U.train(spark.createDataFrame(table, "url string, label int"))
    share = {}
    for name, hosts, ends in (
        ("bad hosts", bad, U.GOOD_PATHS), ("bad paths", [h for h in U.GOOD_HOSTS if h not in good], paths), ("good hosts", good, U.GOOD_PATHS)
    ):
        made = [(k, f"https://www.{h}.test{p}") for k, (h, p) in enumerate((h, p) for h in hosts for p in ends)]
        pages = spark.createDataFrame(made, "page_id long, url string")
        share[name] = np.mean([r["verdict"] == "block" for r in U.judged(pages, model).collect()])
    print(share)
    assert share["bad hosts"] >= 0.6 and share["bad paths"] >= 0.5 and share["good hosts"] <= 0.25


def test_url_edge_cases(spark):
    long = "http://" + "ab" * 20_000 + ".net/es/" + "bc" * 20_000
    pages = spark.createDataFrame(
        [(None, "http://casino-win.org/", 1, "s"), (1, None, 1, "s"), (1, None, 1, "s"), (2, long, 1, "s"), (3, "", 1, "s")],
        "page_id long, url string, host int, score string",
    )
    found = U.judged(pages, U.train(U.labelled_table(spark))).collect()
    assert len(found) == 5 and [r["host"] for r in found if r["page_id"] in (1, 3)] == [""] * 3
    assert [(r["rule"], r["verdict"]) for r in found if r["page_id"] == 2] == [("net/es/", "block")]
    assert [r["verdict"] for r in found if r["page_id"] is None] == ["block"]


def test_url_grams_against_plain_python(spark):
    for host, path in (("casino-win.example.org", "/en/728"), ("", ""), ("é.x", "/12/3a"), ("ab" * 300, "/" + "c" * 200)):
        text = re.sub("[0-9]+", "0", f"^{host}|{path}$")
        grams = {text[i : i + n] for n in U.GRAMS for i in range(max(1, len(text) - n + 1))}
        hashed = spark.createDataFrame([(g,) for g in grams], "g string").select(F.pmod(F.xxhash64("g"), F.lit(U.BUCKETS)).alias("b"))
        found = spark.range(1).select(U.buckets(F.lit(host), F.lit(path)).alias("f")).first()["f"]
        assert sorted(found) == sorted({r["b"] for r in hashed.collect()})


def test_counting_a_batch_holds_few_ngrams(monkeypatch):
    """N-grams are summed on the way; before, a batch held those of all its texts at once."""
    monkeypatch.setattr(R, "HELD", 500)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefg "), 60)) for _ in range(200)]
    langs = ["x" if k % 3 else "y" for k in range(200)]
    summed, held = R._summed, []
    monkeypatch.setattr(R, "_summed", lambda parts: held.append(sum(len(k) for k, _ in parts)) or summed(parts))
    batch = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts)], names=["lang", "text"])
    found = {(r["lang"], r["gram"]): r["n"] for out in R._count(iter([batch])) for r in out.to_pylist()}
    expected = {}
    for lang, text in zip(langs, texts):
        for key, n in zip(*(x.tolist() for x in R.gram_counts(text))):
            expected[lang, key] = expected.get((lang, key), 0) + n
    assert found == expected and max(held) < 2500 < sum(len(R.gram_counts(t)[0]) for t in texts) / 4
