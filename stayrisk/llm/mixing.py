"""Mixing sources to target weights with soft membership, in DataFrame functions only.

A classifier learned from a labelled table gives every document a posterior
over the domains: multinomial naive Bayes on the counts of known words, tempered.
The sum of a document's log-probabilities grows with its length and would make
nearly every posterior 0 or 1, so their mean is taken and counts for ``EVIDENCE``
words (counts are divided by their sum and multiplied by it). The rates then solve a nonnegative
least-squares problem: with tokens n_d, posteriors p_dk and N tokens in all,
the expected share of domain k is ``m_k = sum_d n_d p_dk r_d / N`` and

    minimise  sum_k (m_k - t_k)^2 / s_k   over rates r_d >= 0,

where t_k is the target and s_k the share at rate 1. Every round of projected
gradient is one distributed aggregate of K sums; only those K numbers come to
the driver. In the metric that weights documents by their tokens the gradient
of r_d is ``sum_k p_dk (m_k - t_k) / s_k`` and its largest curvature is 1, so
the fixed step ``STEP`` < 2 converges at any size.

Rates say how often a document is drawn in expectation: 0 leaves it out, 2
repeats it.

The classifier is fitted on a bounded sample (``max_docs`` labelled documents
of at most ``max_chars`` characters, by a hash of their id; of rows that repeat
an id the least text with its own domain) and knows the ``vocabulary`` most
frequent words there; other words carry no evidence. There may be at most
``max_domains`` domains.

Defined results: one row per distinct (id, text), ``copies`` says how many rows
it stands for and ``n_tokens`` counts them all; null and empty texts have no
tokens, the prior as posterior and weight 0 in the sums; a document without a known word has the prior, too; null ids are ids like
others; rows of the labelled table with a null text or domain are left out;
ties between domains go to the alphabetically first; other columns are ignored.
Without any labelled document there is one domain ``all``; without tokens all
rates are 1. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DOCS, MAX_CHARS, VOCABULARY, MAX_DOMAINS = 4000, 50_000, 5000, 64
STEP, ROUNDS, TOLERANCE = 1.8, 60, 1e-4
EVIDENCE = 12.0  # words that a document's average log-probability counts for
#: The five spaces besides the blank, turned into blanks: a split at one character needs no regular expression.
OTHER_SPACES = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.lower(text), OTHER_SPACES, " " * len(OTHER_SPACES)), " "), lambda w: w != "")


@dataclass
class Classifier:
    """Without a model (one domain, or no word) everything has the prior."""

    domains: list[str]
    prior: list[float]
    counter: CountVectorizerModel | None = None
    model: NaiveBayesModel | None = None


def classifier(labelled: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS, vocabulary: int = VOCABULARY,
               max_domains: int = MAX_DOMAINS, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain") -> Classifier:
    """Fit on ``labelled`` (id, text, domain). The sample's ids are chosen first, on ids alone, and then fetch their texts."""
    told = labelled.filter(F.col(id_col).isNotNull() & F.col(domain_col).isNotNull())
    ids = told.select(F.col(id_col).alias("id")).distinct().withColumn("h", F.xxhash64(F.col("id").cast("string"))).orderBy("h", "id").limit(max_docs)
    texts = told.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(domain_col).cast("string").alias("domain"))
    # ``max_docs`` ids at most: as a condition they go below whatever joins ``labelled`` is made of, so only their texts are shuffled
    texts = texts.filter(F.col("id").isin([r["id"] for r in ids.collect()]) & (F.length("text") <= max_chars))
    rows = texts.groupBy("id").agg(F.min(F.struct("text", "domain")).alias("one")).select("id", "one.text", "one.domain").checkpoint()
    found = {r[0]: r[1] for r in rows.groupBy("domain").count().limit(max_domains + 1).collect()}
    if len(found) > max_domains:
        raise ValueError(f"more than {max_domains} domains")
    domains = sorted(found) or ["all"]
    prior = [(found.get(d, 0) + 1) / (sum(found.values()) + len(domains)) for d in domains]
    each = rows.select(F.explode(words(F.col("text"))).alias("word"))
    known = [r[0] for r in each.groupBy("word").count().orderBy(F.desc("count"), "word").limit(vocabulary).collect()]
    if len(domains) == 1 or not known:
        return Classifier(domains, prior)
    counter = CountVectorizerModel.from_vocabulary(known, inputCol="words", outputCol="counts")
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
    sample = counter.transform(rows.select(words(F.col("text")).alias("words"), number.cast("double").alias("label")))
    return Classifier(domains, prior, counter, NaiveBayes(smoothing=1.0, featuresCol="counts").fit(sample))


def posteriors(docs: DataFrame, fitted: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, copies, n_tokens, p_0 ..``: one row per distinct (id, text)."""
    text, ks = F.col(text_col).cast("string"), range(len(fitted.domains))
    each = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.coalesce(words(text), F.array()).alias("words"))
    if fitted.model is None:
        told = each.select("doc_id", "h", F.size("words").alias("n"), *[F.lit(p).alias(f"z_{k}") for k, p in enumerate(fitted.prior)])
    else:
        size = len(fitted.counter.vocabulary)
        mean = Normalizer(p=1.0, inputCol="counts", outputCol="mean")
        weigh = ElementwiseProduct(scalingVec=Vectors.dense([EVIDENCE] * size), inputCol="mean", outputCol="evidence")
        model = fitted.model.copy().setFeaturesCol("evidence").setRawPredictionCol("raw").setProbabilityCol("").setPredictionCol("")
        scored = model.transform(weigh.transform(mean.transform(fitted.counter.transform(each))))
        told = scored.select("doc_id", "h", F.size("words").alias("n"), vector_to_array("raw").alias("z"))
        told = told.select("doc_id", "h", "n", *[F.col("z")[k].alias(f"z_{k}") for k in ks])
        top = F.greatest(*[F.col(f"z_{k}") for k in ks])
        told = told.select("doc_id", "h", "n", *[F.exp(F.col(f"z_{k}") - top).alias(f"z_{k}") for k in ks])
    # rows of one (id, text) have one posterior: any of them
    per = told.groupBy("doc_id", "h").agg(F.count("*").alias("copies"), F.sum("n").cast("long").alias("n_tokens"), *[F.max(f"z_{k}").alias(f"z_{k}") for k in ks])
    norm = reduce(lambda a, b: a + b, [F.col(f"z_{k}") for k in ks])
    return per.select("doc_id", "copies", "n_tokens", *[(F.col(f"z_{k}") / norm).alias(f"p_{k}") for k in ks])


def tempered(shares: list[float], power: float = 0.5) -> list[float]:
    """Targets in proportion to a power of the present shares: small domains gain, large ones lose."""
    raised = [s**power if s > 0 else 0.0 for s in shares]
    return [x / sum(raised) for x in raised] if sum(raised) else shares


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS, tolerance: float = TOLERANCE, **fit) -> DataFrame:
    """``doc_id, copies, n_tokens, domain`` (the likeliest), ``posterior`` (map) and ``rate``.

    ``labelled``: id, text and domain of the documents to learn from.
    ``targets``: share of the tokens by domain, summing to the wanted multiple
    of the present total (usually 1); domains not named get 0. By default the
    present shares, tempered by their square roots.
    """
    model = classifier(labelled, id_col=id_col, text_col=text_col, **fit)
    domains = model.domains
    if targets and (unknown := set(targets) - set(domains)):
        raise ValueError(f"targets name domains that no labelled document has: {sorted(unknown)}")
    ks = range(len(domains))
    table = posteriors(docs, model, id_col, text_col).checkpoint()
    n = F.col("n_tokens").cast("double")
    first = table.agg(F.sum(n), *[F.sum(n * F.col(f"p_{k}")) for k in ks]).first()
    total = first[0] or 0.0
    table = table.withColumn("rate", F.lit(1.0))
    if total:
        share = [first[k + 1] / total for k in ks]
        target = [targets.get(d, 0.0) for d in domains] if targets else tempered(share)
        got = share
        for i in range(rounds):
            if max(abs(g - t) for g, t in zip(got, target)) <= tolerance * sum(target):
                break
            pull = [STEP * (got[k] - target[k]) / share[k] if share[k] else 0.0 for k in ks]
            slope = reduce(lambda a, b: a + b, [F.col(f"p_{k}") * F.lit(float(pull[k])) for k in ks])
            table = table.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - slope))
            if i % 10 == 9:  # keeps the plan short
                table = table.checkpoint()
            last = got
            got = [x / total for x in table.agg(*[F.sum(n * F.col(f"p_{k}") * F.col("rate")) for k in ks]).first()]
            if max(abs(a - b) for a, b in zip(got, last)) <= 1e-3 * tolerance * sum(target):
                break  # the targets are out of reach of what the documents are
    best = F.greatest(*[F.col(f"p_{k}") for k in ks]) if len(domains) > 1 else F.col("p_0")
    domain = F.coalesce(*[F.when(F.col(f"p_{k}") == best, F.lit(d)) for k, d in enumerate(domains)])
    posterior = F.create_map(*[x for k, d in enumerate(domains) for x in (F.lit(d), F.col(f"p_{k}"))])
    return table.select("doc_id", "copies", "n_tokens", domain.alias("domain"), posterior.alias("posterior"), "rate")


def domain_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, domain`` of the labelled documents: the row's language and its id's quality, such as ``de/1``."""
    told = labels.filter("quality IS NOT NULL").select("doc_id", "quality").distinct()
    return docs.select("doc_id", "text", "lang").join(told, "doc_id").select(
        "doc_id", "text", F.concat_ws("/", F.coalesce("lang", F.lit("?")), F.col("quality").cast("string")).alias("domain"))
