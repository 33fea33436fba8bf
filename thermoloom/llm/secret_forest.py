"""Operator 4: secret scan with a random forest that removes false positives.

Any run of 16 token characters is a candidate, and of 8 if it has a digit or is
assigned to a word that announces a secret. A forest trained on labelled findings
scores it from its length, its character transitions, the share of it that
dictionary words cover, path-like marks, and the words beside it. Where rules stand
in for labels, the forest does without the features by which the rules decide, so
that it judges the value itself and can overrule them.
DataFrame functions and Spark's own forest only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, running, stored

_TOKEN = "[A-Za-z0-9+/=_.-]"
CANDIDATE = (
    rf"{_TOKEN}{{16,}}|(?<!{_TOKEN})(?=[A-Za-z+/=_.-]{{0,15}}[0-9]){_TOKEN}{{8,15}}"
    # two cheap looks back before the long one, which they follow from
    r'''|(?<=[:=\s"'])(?<=[:=][\s"']{0,4})(?<=(?:[Pp]assw(?:or)?d|PASSWORD|pwd|PWD|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Kk]ey|KEY)["']?\s{0,2}[:=]\s{0,2}["']?)[A-Za-z0-9+/=_.!@#$%^&*-]{8,15}'''
)
#: The forest is fitted on so many findings at most, chosen by a hash.
FIT_FINDINGS = 20_000
TREES, DEPTH, SEED = 40, 8, 4
#: A dictionary word has so many letters and stands so often in the corpus by itself.
WORD_LETTERS, WORD_COUNT = (4, 15), 5
THRESHOLD = 0.5

#: Words that announce a secret, and values that are only samples.
KEYWORDS = "token secret password passwd pwd api_key apikey api-key access_key auth bearer credential private_key client_secret".split()
SAMPLES = r"example|sample|changeme|placeholder|your[_-]|xxxx|0{8}|1234567"
PREFIXES = r"^(?:AKIA|ASIA|ghp_|gho_|github_pat_|sk_live_|rk_live_|xox[abp]-|AIza|eyJ|glpat-|npm_)"
NAMES = (
    "log_length", "digit_share", "upper_share", "letter_runs", "class_changes", "case_changes", "hex_only", "letters_only", "digits_only", "distinct_share",
    "likelihood", "dictionary", "slashes", "dots", "dashes", "file_end", "prefix", "sample", "keyword", "assigned", "quoted", "url_before", "at_before",
)
#: Features by which :func:`rule_findings` decides.
OF_RULES = ("prefix", "sample", "keyword", "assigned", "quoted", "file_end", "letters_only", "digits_only")
_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def candidates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, row, place, value, before, after) of all candidates.

    ``row`` tells rows with equal doc_id and different texts apart.
    """
    docs = columns(docs, "doc_id", "text").where(F.col("text").rlike(CANDIDATE))
    values = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    pieces = F.split("text", CANDIDATE, -1)
    pairs = F.transform("values", lambda v, i: F.struct(v.alias("value"), F.lower(F.right(F.get(F.col("pieces"), i), F.lit(48))).alias("before"), F.lower(F.left(F.get(F.col("pieces"), i + 1), F.lit(24))).alias("after")))
    split = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), values.alias("values"), pieces.alias("pieces"))
    return split.select("doc_id", "row", F.posexplode(pairs).alias("place", "c")).select("doc_id", "row", "place", "c.*")


def _count(value: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(value, F.lit(pattern)), F.lit(0)).cast("double")


def _pairs(value: Column) -> Column:
    """Letters and digits of a value, as overlapping pairs (found in one pass)."""
    plain = F.regexp_replace(F.lower(value), "[^a-z0-9]", "")
    return F.regexp_extract_all(plain, F.lit("(?=([a-z0-9]{2}))"), F.lit(1))


def transition_weights(found: DataFrame) -> dict[str, float]:
    """Log odds of each character pair in false against true findings.

    ``found`` has value and label; the alphabet bounds the result to 1,296 pairs.
    """
    import math

    counts = found.select("label", F.explode(_pairs(F.col("value"))).alias("pair")).groupBy("pair").agg(F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("words"), F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("secrets"))
    rows = counts.collect()
    words, secrets = (sum(r[k] for r in rows) + len(_LETTERS) ** 2 for k in ("words", "secrets"))
    return {r.pair: math.log((r.words + 1) / words) - math.log((r.secrets + 1) / secrets) for r in rows}


def with_features(found: DataFrame, dictionary: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds one double column per name in :data:`NAMES`.

    ``found`` needs value, before and after; ``dictionary`` has word.
    """
    value, n = F.col("value"), F.length("value").cast("double")
    distinct = found.select("value").distinct()
    pieces = distinct.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{4,}"), F.lit(0))).alias("word"))
    covered = pieces.join(dictionary, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    # one row of an array for each first letter, so that a pair is found by its place
    table = F.array(*[F.lit(weights.get(a + b, 0.0)) for a in _LETTERS for b in _LETTERS])
    at = lambda c: F.instr(F.lit(_LETTERS), c) - 1
    likely = F.aggregate(_pairs(value), F.lit(0.0), lambda a, p: a + F.get(table, at(F.left(p, F.lit(1))) * len(_LETTERS) + at(F.right(p, F.lit(1)))))
    is_ = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    key = "(?:" + "|".join(KEYWORDS) + ")"
    features = {
        "log_length": F.log(n), "digit_share": _count(value, "[0-9]") / n, "upper_share": _count(value, "[A-Z]") / n, "letter_runs": _count(value, "[A-Za-z]+"),
        "class_changes": _count(value, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])") / n, "case_changes": _count(value, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / n,
        "hex_only": is_(value.rlike("^[0-9a-fA-F]+$")), "letters_only": is_(value.rlike("^[A-Za-z]+$")), "digits_only": is_(value.rlike("^[0-9.-]+$")),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / n, "likelihood": likely / n, "dictionary": F.coalesce(F.col("covered") / n, F.lit(0.0)),
        "slashes": _count(value, "/"), "dots": _count(value, r"\."), "dashes": _count(value, "[_-]"), "file_end": is_(value.rlike(r"\.[A-Za-z]{2,4}$")),
        "prefix": is_(value.rlike(PREFIXES)), "sample": is_(F.lower(value).rlike(SAMPLES)), "keyword": is_(F.col("before").rlike(rf"{key}[^a-z]*$")),
        "assigned": is_(F.col("before").rlike(r"[:=]\s*[\"']?$")), "quoted": is_(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")),
        "url_before": is_(F.col("before").rlike(r"(?:https?:|www\.?)/*$")), "at_before": is_(F.col("before").rlike("@$")),
    }
    return found.join(covered, "value", "left").withColumns({k: F.coalesce(features[k].cast("double"), F.lit(0.0)) for k in NAMES}).drop("covered")


def corpus_dictionary(docs: DataFrame) -> DataFrame:
    """Rows (word): plain words that occur often in the corpus as words of their own."""
    low, high = WORD_LETTERS
    words = columns(docs, "text").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<![\p{{L}}0-9])[a-z]{{{low},{high}}}(?![\p{{L}}0-9])"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= WORD_COUNT).select("word")


def rule_findings(found: DataFrame) -> DataFrame:
    """Labelled findings (value, before, after, label) by plain rules, for a corpus
    whose findings nobody has labelled: assigned to a keyword or of a known
    prefix and no sample is 1; words, numbers, paths, hosts and samples are 0;
    what no rule settles is left out."""
    value = F.col("value")
    keyed = F.col("before").rlike("(?:" + "|".join(KEYWORDS) + r")\s*[:=]\s*[\"']?$")
    sample = F.lower(value).rlike(SAMPLES)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    label = F.when(sample, 0).when((keyed & mixed) | value.rlike(PREFIXES), 1).when(~mixed | value.rlike(r"^[a-z0-9-]+(?:\.[a-z0-9-]+)+$") | value.rlike(r"^/|\.[A-Za-z]{2,4}$"), 0)
    return found.select("value", "before", "after", label.alias("label")).where("label is not null")


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, fit_findings: int = FIT_FINDINGS) -> DataFrame:
    """Rows (doc_id, place, value_sha256, length, score, secret), one per candidate.

    ``docs`` needs doc_id and text, ``findings`` value, before, after and label
    (0 or 1); without them the rules of :func:`rule_findings` label the corpus.
    ``place`` counts the candidates of a text from 0. Null and empty texts have
    none; repeated rows count once; without findings of both labels the score is
    their common label, 0 without any.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    with running(docs.sparkSession):
        found = stored(candidates(docs).distinct(), "candidates")
        known = rule_findings(found) if findings is None else columns(findings, "value", "before", "after", "label").where("label in (0, 1) and value is not null")
        # the same share of either label, so that a rare one is not lost in the bound
        per = [known.where(F.col("label") == k).distinct().orderBy(F.xxhash64("value", "before"), "value", "before", "after").limit(fit_findings // 2) for k in (0, 1)]
        sample = stored(per[0].unionByName(per[1]), "findings")
        dictionary = stored(corpus_dictionary(docs), "dictionary")
        weights = transition_weights(sample)
        used = [n for n in NAMES if findings is not None or n not in OF_RULES]
        vectors = VectorAssembler(inputCols=used, outputCol="features")
        featured = stored(with_features(found, dictionary, weights), "featured")
        labels = [r.label for r in sample.select("label").distinct().collect()]
        if len(labels) == 2:
            train = stored(with_features(sample, dictionary, weights).select("label", *NAMES), "train")
            forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label").fit(vectors.transform(train))
            scored = forest.transform(vectors.transform(featured)).withColumn("score", vector_to_array("probability")[1])
        else:
            scored = featured.withColumn("score", F.lit(float(labels[0] if labels else 0)))
    return scored.select("doc_id", "place", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length"), "score", (F.col("score") >= THRESHOLD).alias("secret"))
