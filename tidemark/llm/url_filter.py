"""URL verdicts: rules first, then a ratio of two character language models.

Rules (host, path) fit their host and all its subdomains if the path of the URL starts with
theirs; the longest rule wins. URLs that a rule allows or blocks are the accepted and rejected
examples of two Markov models, counted over all rows. A model of variable order backs off from
three characters of context to none by Witten-Bell weights, so each context is trusted as far
as it was seen. A URL without a rule is judged by

    (log P(url | accepted) - log P(url | rejected)) / length  >=  threshold

The threshold lies between the class means, weighted by their spreads, on examples whose hash
keeps them out of the counts. It is 0 if a class has no such examples.

Characters are mapped to an alphabet of 39 symbols (letters in lower case, one for digits,
ten separators, one for all others; 0 is the start), so the model has at most
39**4 numbers whatever the input: that is the proven bound of what is broadcast. Characters
meet it in a broadcast join and are summed per row before anything is shuffled.

Null URLs and those without `://` have an empty host and path and fit no rule. Null and empty URLs
score 0. Repeated rows are repeated examples. An empty table gives an empty result. Other columns are ignored.
"""

from pyspark.sql import functions as F

from tidemark.session import work_folder

LETTERS = "abcdefghijklmnopqrstuvwxyz0/.-_:?=&#%"
OTHER = "*"
SYMBOLS = len(LETTERS) + 2  # with OTHER and the start
ORDER = 4
HELD_OUT = 5


def url_parts(url):
    """Host (A-Z lower-cased) and path of a URL column."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(
        F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def first_rule(host, path, rules):
    """The longest fitting rule as struct (rule, verdict), null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def with_grams(df):
    """Add `grams`: for every character of `url` the code of it and its three predecessors."""
    plain = F.regexp_replace(F.lower("url"), "[0-9]", "0")
    plain = F.regexp_replace(plain, r"(?s)[^a-z0/.\-_:?=&#%]", OTHER)
    codes = F.transform(
        F.filter(F.split(F.coalesce(plain, F.lit("")), ""), lambda c: c != ""),
        lambda c: F.instr(F.lit(LETTERS + OTHER), c).cast("long"),
    )
    padded = F.concat(F.array(*[F.lit(0).cast("long")] * (ORDER - 1)), codes)
    # A column of its own: read four times below, computed once.
    shifted = [F.slice("padded", i + 1, F.size("padded") - ORDER + 1).alias(f"c{i}") for i in range(ORDER)]
    code = lambda z: ((z["c0"] * SYMBOLS + z["c1"]) * SYMBOLS + z["c2"]) * SYMBOLS + z["c3"]
    return df.withColumn("padded", padded).withColumn("grams", F.transform(F.arrays_zip(*shifted), code)).drop("padded")


def gram_ratios(counts):
    """Log ratio (gram, ratio) of every counted gram from rows (gram, accepted, rejected).

    Level k holds the grams cut to their last k characters: at most SYMBOLS**k rows. Tables that are
    broadcast have at most SYMBOLS**(ORDER - 1) rows.
    """
    classes = ("accepted", "rejected")
    uniform = F.lit(1.0 / SYMBOLS)
    below = counts.sparkSession.range(1).select(F.lit(0).cast("long").alias("shorter"), *[uniform.alias(f"p_{c}") for c in classes])
    for order in range(1, ORDER + 1):
        level = (
            counts.groupBy((F.col("gram") % SYMBOLS**order).alias("gram"))
            .agg(*[F.sum(c).alias(c) for c in classes])
            .withColumns({"context": F.expr(f"gram div {SYMBOLS}"), "shorter": F.col("gram") % SYMBOLS ** (order - 1)})
        )
        contexts = level.groupBy("context").agg(
            *[F.sum(c).alias(f"n_{c}") for c in classes], *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in classes]
        )
        p = {
            c: F.when(
                F.col(f"n_{c}") > 0,
                (F.col(c) + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"kinds_{c}")),
            ).otherwise(F.col(f"p_{c}"))
            for c in classes
        }
        joined = level.join(F.broadcast(contexts), "context").join(F.broadcast(below), "shorter")
        below = joined.select(F.col("gram").alias("shorter"), *[p[c].alias(f"p_{c}") for c in classes])
    return below.select(F.col("shorter").alias("gram"), (F.log("p_accepted") - F.log("p_rejected")).alias("ratio"))


def judge_urls(df, rules, id_col="page_id", url_col="url"):
    """Rows (id, host, path, rule, verdict, score): the rule's verdict, else the models'."""
    spark = df.sparkSession
    host, path = url_parts(F.col(url_col))
    rows = (
        df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
        .withColumn("fit", first_rule(F.col("host"), F.col("path"), rules))
        .withColumns(
            {
                "row": F.monotonically_increasing_id(),
                "label": (F.col("fit.verdict") == "allow").cast("long"),
                "held_out": F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0,
            }
        )
    )
    counted = F.when(~F.col("held_out"), F.col("label"))
    counts = spark.read.parquet(
        _written(
            with_grams(rows.select("url", counted.alias("label")))
            .select("label", F.explode("grams").alias("gram"))
            .groupBy("gram")
            .agg(F.count_if(F.col("label") == 1).alias("accepted"), F.count_if(F.col("label") == 0).alias("rejected")),
            "gram-counts",
        )
    )
    ratios = spark.read.parquet(_written(gram_ratios(counts), "gram-ratios"))
    # Sums per row combine within the task that made the characters; null and empty URLs keep one row without gram.
    kept = ["row", "id", "host", "path", "fit", "label", "held_out"]
    scored = (
        with_grams(rows)
        .select(*kept, F.explode_outer("grams").alias("gram"))
        .join(F.broadcast(ratios), "gram", "left")
        .groupBy(*kept)
        .agg(F.coalesce(F.avg("ratio"), F.lit(0.0)).alias("score"))
    )
    scored = spark.read.parquet(_written(scored, "scored-urls"))

    def stats(label):
        return [f(F.when(F.col("label") == label, F.col("score"))) for f in (F.avg, F.stddev_pop)]

    (mean1, spread1), (mean0, spread0) = stats(1), stats(0)
    spread0, spread1 = spread0 + 1e-9, spread1 + 1e-9
    between = F.coalesce((mean1 * spread0 + mean0 * spread1) / (spread0 + spread1), F.lit(0.0))
    threshold = scored.filter("held_out and label is not null").agg(between.alias("threshold")).scalar()
    return scored.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"),
        "score",
    )


def _written(df, name):
    """Path of the rows, written to the shared folder."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return path
