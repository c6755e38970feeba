"""Secret scan: findings by pattern, false positives removed by a random forest.

A finding is a long run of key-like characters in a word, which may hold several. The forest sees its length, how its characters
change from kind to kind, how much of it dictionary words cover, the document's path and the words next to
it; it is fitted on labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from .base import let, small_side, words

CORE = r"[A-Za-z0-9+/_=\-]{16,}"
#: Where a word that holds several findings is parted into fields; no finding holds one. Characters of context that
#: findings of one word repeat at most.
FIELD, NEAR = r"[,;&|]", 200
#: Words next to a finding that speak for a secret, or for a harmless value.
KEY_WORDS = r"(?i)token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer"
PLAIN_WORDS = r"(?i)example|sample|dummy|fake|placeholder|checksum|sha\d*|md5|commit|digest|uuid|version|build"
PLAIN_PATHS = r"(?i)test|example|sample|fixture|mock|vendor|lock|doc"
#: Labelled findings that the forest is fitted on at most; words count as a dictionary's from so many documents on.
LABELLED, IN_DOCUMENTS = 20_000, 3
#: Findings' parts up to which they are broadcast (a letter run each).
BROADCAST_PARTS = 1_000_000
FEATURES = (
    "length digits uppers lowers marks changes distinct covered longest_run hex_only digits_only path_plain key_near plain_near"
    " assigned quoted"
).split()


def _runs(x: Column) -> Column:
    """All findings in a word, in order, each with the word, or what of it stands next to the finding if there are several.

    That is the field's text from the finding before to the one after, and the field's start. The sizes add up to
    a multiple of the word's, however many findings it holds.
    """

    def of_field(f: Column) -> Column:
        start = lambda j: F.when(j > 0, F.left(f, F.lit(NEAR))).otherwise("")
        around = lambda gaps, r, j: F.concat(start(j), F.get(gaps, j), r, F.get(gaps, j + 1)).alias("word")
        found = F.regexp_extract_all(f, F.lit(CORE), F.lit(0))
        return let(F.split(f, CORE), lambda gaps: F.transform(found, lambda r, j: F.struct(r.alias("finding"), around(gaps, r, j))))

    alone = lambda p: F.transform(p, lambda y: F.struct(y["finding"].alias("finding"), x.alias("word")))
    return let(F.flatten(F.transform(F.split(x, FIELD), of_field)), lambda p: F.when(F.size(p) == 1, alone(p)).otherwise(p))


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """A row per finding: key, path, at (number of its word), run (its number in the word), finding, before (up to three
    words), word (see ``_runs``), after.

    Findings of less than 24 characters need a digit. NULL texts have none.
    """

    def of(w: Column) -> Column:
        hit = lambda x: (F.length(x) >= 16) & x.rlike(CORE)

        def rows(x: Column, i: Column, p: Column) -> Column:
            before = F.array_join(F.slice(w, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3))), " ")
            after = F.coalesce(F.get(w, i + 1), F.lit(""))
            return F.transform(
                p,
                lambda y, k: F.struct(
                    i.alias("at"),
                    k.alias("run"),
                    y["finding"].alias("finding"),
                    F.when(k == 0, before).otherwise(F.right(before, F.lit(NEAR))).alias("before"),
                    y["word"].alias("word"),
                    F.when(k == F.size(p) - 1, after).otherwise(F.left(after, F.lit(NEAR))).alias("after"),
                ),
            )

        near = lambda x, i: F.when(hit(x), let(_runs(x), lambda p: rows(x, i, p)))
        return F.flatten(F.filter(F.transform(w, near), lambda x: x.isNotNull()))

    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path")
    found = docs.select(F.col(id_col).alias("key"), path, F.explode(let(words(F.col(text_col)), of)).alias("x"))
    return found.select("key", "path", "x.*").where((F.length("finding") >= 24) | F.col("finding").rlike(r"\d"))


def dictionary(docs: DataFrame, text_col: str = "text", documents: int = IN_DOCUMENTS) -> DataFrame:
    """Lower-case words of 3 to 15 letters that ``documents`` texts or more hold, counted over all texts."""
    own = F.array_distinct(F.filter(words(F.lower(F.col(text_col))), lambda w: w.rlike(r"^\p{L}{3,15}[.,;:!?]?$")))
    each = docs.select(F.explode(own).alias("w")).select(F.regexp_replace("w", r"[.,;:!?]$", "").alias("part"))
    return each.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") >= documents).select("part")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def featured(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``found`` with the forest's features; the dictionary is that of ``docs``."""
    runs = F.array_distinct(F.regexp_extract_all(F.lower("finding"), F.lit(r"[a-z]{3,}"), F.lit(0)))
    distinct = found.select("finding").distinct().withColumn("runs", runs)
    parts = distinct.select("finding", F.explode("runs").alias("part"))
    known = dictionary(docs, text_col)
    asked = cut_lineage(parts.select("part").distinct())
    known = known.join(small_side(asked, asked.count(), BROADCAST_PARTS), "part")  # semi-join: parts are distinct on both sides
    covered = parts.join(known, "part").groupBy("finding").agg(F.sum(F.length("part")).cast("double").alias("covered_chars"))
    f = F.col("finding")
    out = found.join(covered, "finding", "left")
    n = F.length(f).cast("double")
    made = {
        "length": n,
        "digits": _count(f, r"\d") / n,
        "uppers": _count(f, "[A-Z]") / n,
        "lowers": _count(f, "[a-z]") / n,
        "marks": _count(f, r"[+/_=\-]") / n,
        "changes": _count(f, r"(?<=\d)(?=[A-Za-z])|(?<=[A-Za-z])(?=\d)|(?<=[a-z])(?=[A-Z])") / n,
        "distinct": F.size(F.array_distinct(F.split(f, ""))) / F.least(n, F.lit(64.0)),
        "covered": F.coalesce(F.col("covered_chars"), F.lit(0.0)) / n,
        "longest_run": F.array_max(
            F.concat(F.array(F.lit(0)), F.transform(F.regexp_extract_all(f, F.lit("[A-Za-z]+"), F.lit(0)), lambda x: F.length(x)))
        )
        / n,
        "hex_only": f.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "digits_only": f.rlike(r"^\d+$").cast("double"),
        "path_plain": F.col("path").rlike(PLAIN_PATHS).cast("double"),
        "key_near": (F.col("before").rlike(KEY_WORDS) | F.col("word").rlike(KEY_WORDS)).cast("double"),
        "plain_near": (F.col("before").rlike(PLAIN_WORDS) | F.col("after").rlike(PLAIN_WORDS)).cast("double"),
        "assigned": (F.col("before").rlike("[=:]$") | F.col("word").rlike(r"^\w+[=:]")).cast("double"),
        "quoted": F.col("word").rlike("""["'`]""").cast("double"),
    }
    return out.withColumns(made).drop("covered_chars")


def rule_label(found: DataFrame) -> DataFrame:
    """``found`` with a label where the finding's form leaves no doubt: 1.0 or 0.0, else NULL.

    A key word with an assigned, quoted value of letters and digits is a secret; digits alone, letters alone
    and parts of mail or web addresses are none.
    """
    f, mixed = F.col("finding"), F.col("finding").rlike("[A-Za-z]") & F.col("finding").rlike(r"\d")
    secret = mixed & (F.col("key_near") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & (F.col("plain_near") == 0)
    plain = f.rlike(r"^\d+$") | f.rlike(r"^[A-Za-z\-_/]+$") | F.col("word").rlike("@|://|www[.]")
    return found.withColumn("label", F.when(secret, 1.0).when(plain, 0.0))


def fit(labelled: DataFrame, rows: int = LABELLED, trees: int = 20, depth: int = 6, seed: int = 7):
    """A forest over FEATURES for ``label``, or None if there are not both labels.

    It is fitted on at most ``rows`` labelled findings, half of them for each label, the first by a hash of
    their features, in one partition, so the forest depends on nothing but the findings.
    """
    known = labelled.where(F.col("label").isNotNull()).select("label", *FEATURES).withColumn("h", F.xxhash64(*FEATURES))
    parts = []
    for x in (0.0, 1.0):
        own, half = known.where(F.col("label") == x), rows // 2
        # the bound first, from hashes alone; what lies under it is that many rows and ties
        last = own.select("h").orderBy("h").limit(half).agg(F.max("h")).first()[0]
        parts.append(own.where(F.col("h") <= F.lit(last).cast("long")).orderBy("h", *FEATURES).limit(half))
    some = cut_lineage(parts[0].union(parts[1]).coalesce(1).sortWithinPartitions("h", "label", *FEATURES))
    if some.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(some))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Columns ``id_col``, at, run, finding, score, secret: a row per finding in ``docs``.

    ``labelled`` has FEATURES and label; by default the findings themselves where ``rule_label`` is sure.
    ``secret`` is score >= 0.5. Without both labels the score is ``rule_label``'s, 0 where it has no opinion.
    Rows stored twice are scanned twice. Texts are scanned whole, however long; a NULL or empty text has no findings, nor has
    an empty table. Other columns, whatever their names, are not read.
    """
    found = cut_lineage(rule_label(featured(findings(docs, id_col, text_col, path_col), docs, text_col)))
    forest = fit(found if labelled is None else labelled)
    if forest is None:
        scored = found.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(found)
        forest.setFeaturesCol("__features")
        scored = forest.transform(ready).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return scored.select(F.col("key").alias(id_col), "at", "run", "finding", "score", (F.col("score") >= 0.5).alias("secret"))
