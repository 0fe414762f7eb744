"""URL filters: host and path rules first, then logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table by batch gradient descent with momentum, as one fold
over the table in a single row; its state is one array of weights.  Judging a
URL is a column expression inside its row: no shuffle, and no key that could be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions.text import let

#: Length of the weight array.  It is the only thing that travels with the tasks: 64 KB.
BUCKETS = 8192
GRAMS = (3, 4, 5)
#: Log-odds of a URL that the model knows nothing of: it is allowed.
BIAS = -0.7
STEPS = 150
#: Features have length one, so the mean loss allows steps of this size; momentum does the rest.
RATE = 10.0
MOMENTUM = 0.9
#: Most labelled rows that training takes; a longer table is refused, not cut.
MOST_LABELLED = 10_000
THRESHOLD = 0.5

#: (host, path): each fits its host and all subdomains of it, below its path.
ALLOW = (("com", "/"), ("www.example.com", "/en/"))
BLOCK = (("example.com", "/en/"), ("net", "/es/"), ("net", "/fr/"))

#: Host names of the labelled URLs: to be blocked, and others.  Common English words, chosen without a look at any table.
BAD_HOSTS = (
    "casino-royal", "grand-casino", "online-casino", "bets-for-all", "best-bets-now", "poker-win", "jackpot-slots",
    "pills-shop", "cheap-meds-pills", "pharma-pills", "adult-video", "adult-cams", "xxx-adult", "track-visitors", "click-ads",
    "banner-ads-net", "spam-mail", "link-spam", "seo-farm", "win-free-prize", "payday-loan-cheap", "replica-cheap",
    "crack-torrent", "malware-download",
)
GOOD_HOSTS = (
    "library", "weather", "news-online", "gardening", "recipes", "museum", "university", "travel", "history", "physics",
    "mountains", "bakery", "football", "school-board", "village", "orchestra", "bicycle-club", "city-library", "hospital",
    "railway", "farm-market", "cinema", "music-now", "river",
)
#: Paths of the labelled URLs: to be blocked on any host, and others, which come with either kind of host.
BAD_PATHS = (
    "/casino/bonus", "/free/pills", "/win/prize?id=7", "/xxx/cams/", "/cheap/replica-watches", "/poker/jackpot.html",
    "/crack/download", "/ads/click?to=9",
)
GOOD_PATHS = (
    "/en/10", "/articles/garden-soil", "/de/20.html", "/about/team", "/fr/30/", "/docs/guide.html", "/es/40?page=2", "/news/2021/07#top",
)
#: Dealt in turn to both labels, so that these tell nothing.
FRONTS = ("http://", "https://www.", "https://m.", "http://blog.")
DOMAIN = ".test"


def labelled_urls() -> list[tuple[str, int]]:
    """The labelled table: (url, label), 1 is to be blocked, be it for its host or for its path.

    Both labels have as many rows, so that what all URLs share tells nothing.
    """
    kinds = ((BAD_HOSTS, GOOD_PATHS, 3, 1), (GOOD_HOSTS, BAD_PATHS, 2, 1), (GOOD_HOSTS, GOOD_PATHS, 5, 0))
    return [
        (FRONTS[(k + n) % len(FRONTS)] + host + DOMAIN + paths[(k + 3 * n) % len(paths)], label)
        for hosts, paths, each, label in kinds
        for k, host in enumerate(hosts)
        for n in range(each)
    ]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
    there up to ``?``, ``#`` or the end.  A null url, or one without ``://``, has both empty."""
    first = F.instr(url, "://")
    rest = F.when(first > 0, F.substring(url, first + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, allow=ALLOW, block=BLOCK) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    ``allow`` and ``block`` are lists kept by hand; they become part of the expression.
    """
    rules = [(h, p, "allow") for h, p in allow] + [(h, p, "block") for h, p in block]
    fitting = None
    # From the shortest to the longest, so that the outermost test is the longest rule's.
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, found) if fitting is None else F.when(fits, found).otherwise(fitting)
    if fitting is None:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return fitting


def buckets(host: Column, path: Column) -> Column:
    """Distinct hash buckets of the character n-grams of host and path, digits folded to one sign."""
    folded = F.regexp_replace(F.concat(F.lit("^"), host, F.lit("|"), path, F.lit("$")), "[0-9]+", "0")
    # Characters first: a substring of a long URL is found by going there from its start.
    return let(F.split(folded, ""), _buckets_of)


def _buckets_of(chars: Column) -> Column:
    def grams(n: int) -> Column:
        def bucket(i: Column) -> Column:
            gram = F.concat_ws("", *[F.get(chars, i + k) for k in range(n)])
            return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")

        # Spark gives a second parameter of a lambda the index, so ``n`` must not be one.
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(chars) - n)), bucket)

    return F.array_distinct(F.flatten(F.array(*map(grams, GRAMS))))


def score(features: Column, weights: list[float], bias: float) -> Column:
    """Probability of label 1; the feature vector has length one."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # one literal, folded once
    total = F.aggregate(features, F.lit(0.0), lambda s, b: s + F.get(table, b))
    z = F.lit(bias) + total / F.sqrt(F.greatest(F.size(features), F.lit(1)).cast("double"))
    return 1 / (1 + F.exp(-z))


def train(labelled: DataFrame, steps: int = STEPS, rate: float = RATE) -> tuple[list[float], float]:
    """Weights and bias from (url, label).  Rows with a null url or label are left out.

    The labelled table is small by contract (``MOST_LABELLED``, else refused), so it becomes one row: its
    examples, and for every bucket the examples that have it.  All steps are one fold over that row.  A
    table without rows gives zero weights, which allow everything.
    """
    rows = labelled.where("url is not null and label is not null")
    n = rows.limit(MOST_LABELLED + 1).count()
    if n > MOST_LABELLED:
        raise ValueError(f"more than {MOST_LABELLED} labelled urls")
    if n == 0:
        return [0.0] * BUCKETS, BIAS
    host, path = host_and_path(F.col("url"))
    table = rows.select(F.col("label").cast("double").alias("y"), buckets(host, path).alias("f"))
    table = table.agg(F.sort_array(F.collect_list(F.struct("y", "f"))).alias("examples"))
    table = table.withColumn("known", F.sort_array(F.array_distinct(F.flatten(F.transform("examples", lambda e: e["f"])))))
    known = F.col("known")
    places = F.transform(
        "examples",
        lambda e: F.struct(
            e["y"].alias("y"),
            (1 / F.sqrt(F.size(e["f"]).cast("double"))).alias("s"),
            F.transform(e["f"], lambda b: (F.array_position(known, b) - 1).cast("int")).alias("f"),
        ),
    )
    holders = F.transform(
        known,
        lambda b: F.filter(
            F.transform("examples", lambda e, r: F.when(F.array_contains(e["f"], b), r)), lambda r: r.isNotNull()
        ),
    )
    table = table.select("known", places.alias("rows"), holders.alias("holders"))
    examples, holders = F.col("rows"), F.col("holders")
    zeros = F.transform("known", lambda _: F.lit(0.0))

    def step(state: Column, _: Column) -> Column:
        # Nesterov: the gradient is taken at the place ahead; ``at`` is where the last step ended.
        def offs(e: Column) -> Column:
            total = F.aggregate(e["f"], F.lit(0.0), lambda t, j: t + F.get(state["ahead"], j))
            return 1 / (1 + F.exp(-(F.lit(BIAS) + e["s"] * total))) - e["y"]

        def moved(off: Column) -> Column:
            def slope(members: Column) -> Column:
                return F.aggregate(members, F.lit(0.0), lambda t, r: t + F.get(off, r) * F.get(examples, r)["s"])

            new = F.transform(holders, lambda members, j: F.get(state["ahead"], j) - rate / n * slope(members))
            return let(
                new,
                lambda at: F.struct(
                    at.alias("at"),
                    F.zip_with(at, state["at"], lambda x, old: x + MOMENTUM * (x - old)).alias("ahead"),
                ),
            )

        return let(F.transform(examples, offs), moved)

    start = F.struct(zeros.alias("at"), zeros.alias("ahead"))
    model = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)
    found = table.select("known", model.alias("m")).select("known", "m.at").first()
    weights = [0.0] * BUCKETS
    for bucket, weight in zip(found["known"], found["at"], strict=True):
        weights[bucket] = weight
    return weights, BIAS


def labelled_table(spark: SparkSession) -> DataFrame:
    """:func:`labelled_urls` as literals of the plan."""
    rows = F.array(*[F.struct(F.lit(url).alias("url"), F.lit(label).alias("label")) for url, label in labelled_urls()])
    return spark.range(1).select(F.inline(rows))


def judged(pages: DataFrame, model: tuple[list[float], float], id_col: str = "page_id", url_col: str = "url",
           allow=ALLOW, block=BLOCK) -> DataFrame:
    """id, host, path, rule, score and verdict (allow or block) of every row.

    A null or unreadable url has an empty host and path and gets the verdict of the model like any
    other.  Repeated rows are judged each on its own; other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", longest_rule(F.col("host"), F.col("path"), allow, block))
    rows = rows.withColumn("features", buckets(F.col("host"), F.col("path")))
    rows = rows.withColumn("score", score(F.col("features"), *model))
    told = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    return rows.select(
        F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"), "score",
        F.coalesce(F.col("fit.verdict"), told).alias("verdict"),
    )
