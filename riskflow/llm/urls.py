"""URL filters in DataFrame functions: rules by host and path, and a classifier for the rest.

A rule fits its host and all subdomains where the path starts with the rule's; the longest decides.
URLs that no rule fits are judged by logistic regression on hashed character n-grams of host and
path, trained from a small table of labelled URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import ascii_lower, stored

ALLOW, BLOCK = "allow", "block"
GRAMS = (3, 4)
BUCKETS = 1 << 12


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, null if none does.

    Of rules of one length the first listed decides. ``rules`` is a list of the driver.
    """
    kind = "struct<name:string,verdict:string,host:string,path:string>"
    ordered = sorted(rules, key=lambda r: -len(r.name))
    table = F.array(*[
        F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"),
                 F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in ordered
    ]).cast(f"array<{kind}>")
    fits = F.filter(table, lambda r: F.startswith(path, r["path"]) & (
        (host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))
    ))
    return F.get(fits, F.lit(0))


def _grams(mark: str, text: Column, n: int) -> Column:
    """The n-grams of a text with its ends marked, each tagged with where it comes from."""
    closed = F.concat(F.lit("^"), text, F.lit("$"))
    last = F.char_length(closed) - (n - 1)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                      lambda i: F.concat(F.lit(mark), F.substring(closed, i, F.lit(n))))
    return F.when(last > 0, cut).otherwise(F.array().cast("array<string>"))


def _featured(urls: DataFrame) -> DataFrame:
    """``urls`` (with __host, __path) and a vector of hashed n-gram presence."""
    grams = [_grams(mark, F.col(name), n) for mark, name in (("h", "__host"), ("p", "__path"))
             for n in GRAMS]
    hashing = HashingTF(inputCol="__grams", outputCol="__features", numFeatures=BUCKETS, binary=True)
    return hashing.transform(urls.withColumn("__grams", F.concat(*grams)))


def train(labelled: DataFrame, *, url_col: str = "url", label_col: str = "label",
          ridge: float = 0.01, max_rows: int = 5_000) -> LogisticRegressionModel | str:
    """Fit the classifier on ``labelled`` URLs (label ``allow`` or ``block``).

    Each distinct URL counts once; of more than ``max_rows`` those of the smallest hashes are taken.
    Without both labels the result is the only label there is, ``allow`` for an empty table.
    """
    rows = labelled.select(
        host_of(F.col(url_col)).alias("__host"), path_of(F.col(url_col)).alias("__path"),
        (F.col(label_col) == BLOCK).cast("double").alias("label"),
    ).where("label is not null").groupBy("__host", "__path").agg(F.max("label").alias("label"))
    rows = stored(rows.orderBy(F.xxhash64("__host", "__path"), "__host", "__path").limit(max_rows),
                  "labelled-urls")
    found = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if len(found) < 2:
        return BLOCK if found == [1.0] else ALLOW
    fit = LogisticRegression(featuresCol="__features", labelCol="label", regParam=ridge, maxIter=50)
    return fit.fit(_featured(rows))


def judged(urls: DataFrame, rules: list[Rule], model: LogisticRegressionModel | str, *,
           url_col: str = "url") -> DataFrame:
    """``urls`` with host, path, rule (name or null), score (of ``block``) and verdict.

    Existing columns of these names are replaced. A null URL, or one without ``://``, has an empty
    host and path, which no rule with a path fits. Repeated rows stay; an empty table stays empty.
    """
    own = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "score", "verdict")]
    parsed = urls.select(*own, host_of(F.col(url_col)).alias("__host"),
                         path_of(F.col(url_col)).alias("__path"))
    parsed = parsed.withColumn("__rule", rule_for(F.col("__host"), F.col("__path"), rules))
    if isinstance(model, str):
        scored = parsed.withColumn("__score", F.lit(1.0 if model == BLOCK else 0.0))
    else:
        # Only the columns that this model adds are used; a clashing name cannot get between.
        model = model.copy().setPredictionCol("__prediction").setProbabilityCol("__probability") \
            .setRawPredictionCol("__raw")
        scored = model.transform(_featured(parsed)).withColumn(
            "__score", vector_to_array("__probability")[1]
        )
    by_model = F.when(F.col("__score") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(
        *own, F.col("__host").alias("host"), F.col("__path").alias("path"),
        F.col("__rule.name").alias("rule"), F.col("__score").alias("score"),
        F.coalesce("__rule.verdict", by_model).alias("verdict"),
    )


def labelled_by_rules(urls: DataFrame, rules: list[Rule], *, url_col: str = "url") -> DataFrame:
    """The URLs that a rule fits, with its verdict as their label."""
    url = F.col(url_col)
    found = urls.select(url.alias("url"), rule_for(host_of(url), path_of(url), rules).alias("rule"))
    return found.where("rule is not null").select("url", F.col("rule.verdict").alias("label"))
