"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

Only DataFrame functions and Spark's own learners are used. Texts are scanned for long
unbroken strings and for the words of the dictionary; all else works on these candidates
and their neighbourhood.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settle

#: Candidates: unbroken strings of at least this many of the characters that keys are made of.
MIN_LENGTH = 16
#: Characters of candidates right behind a keyword, whatever they are but blanks.
MIN_ASSIGNED = 6
#: Characters before and behind a candidate that count as its neighbourhood.
REACH = 80
#: Labelled findings that the forest is fitted on, the smallest hashes of either label.
FIT_ROWS = 10_000
#: A word of the dictionary occurs this often in all texts.
MIN_WORD_COUNT = 20
#: Keywords that announce a secret, as a fixed value.
KEYWORDS = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "auth", "bearer", "private")
#: Well-known forms of keys, as fixed values.
KNOWN_FORMS = (r"AKIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36}", r"xox[abprs]-[A-Za-z0-9\-]{10,}", r"sk_live_[A-Za-z0-9]{16,}")
NEIGHBOUR_BUCKETS = 32
#: Right behind an assignment to a keyword; the cheap look at the characters before comes first.
_ASSIGNED = (
    r"(?<=[=:>\s\"'])(?<=[=:]>?\s{0,2}[\"']?)"
    rf"(?<=(?i:{'|'.join(KEYWORDS)})[\w\-]{{0,16}}[\"']?\s{{0,2}}[=:]{{1,2}}>?\s{{0,2}}[\"']?)"
)
_BEARER = r"(?<=\s)(?<=(?i:bearer)\s)"
#: A whole value in quotes, or a run without blanks and quotes.
_VALUE = (
    rf"(?:(?<=\")[^\s\"]{{{MIN_ASSIGNED},}}+(?=\")|(?<=')[^\s']{{{MIN_ASSIGNED},}}+(?=')"
    rf"|(?![=:>])[^\s\"']{{{MIN_ASSIGNED},}}+)"
)
#: The password of a URL's user, or a user that is a key.
_USER = rf"(?<=:)(?<=://[^\s/:@]{{0,64}}:)[^\s/@]++(?=@)|(?<=://)[^\s/:@]{{{MIN_ASSIGNED},}}+(?=@)"
CANDIDATE = rf"{_ASSIGNED}{_VALUE}|{_BEARER}{_VALUE}|{_USER}|[A-Za-z0-9_/+\-]{{{MIN_LENGTH},}}+"

_NUMERIC = (
    "length", "digit_share", "upper_share", "hex_share", "switches", "case_switches", "distinct_share",
    "longest_letters", "rare_pairs", "dictionary_share", "path_depth", "in_path", "in_address", "assigned",
    "quoted", "announced",
)


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: unbroken strings of ``MIN_LENGTH`` characters of keys, runs of
    ``MIN_ASSIGNED`` of any characters but blanks that are assigned to a keyword or follow
    "bearer", and the user parts of URLs. Columns ``key``, ``path``, ``start`` (from 0), ``candidate``, ``before``, ``behind``.

    Candidates are found in one pass over the whole text. The texts between them give the
    neighbourhoods, so a neighbourhood never reaches into the next candidate.
    """
    value = F.col("__text")
    rows = docs.select(F.col(key).alias("key"), F.col(path).alias("path"), F.col(text).alias("__text"))
    # Rows without a candidate are most of them; the filter reads on until it finds one.
    rows = rows.filter(F.rlike(value, F.lit(CANDIDATE)))
    found = F.regexp_extract_all(value, F.lit(CANDIDATE), F.lit(0))
    gaps = F.split(value, CANDIDATE, -1)
    rows = rows.select("key", "path", found.alias("found"), gaps.alias("gaps"))
    near = F.transform(
        "found",
        lambda c, i: F.struct(
            c.alias("candidate"),
            F.length(F.get("gaps", i)).alias("gap"),
            F.right(F.get("gaps", i), F.lit(REACH)).alias("before"),
            F.left(F.get("gaps", i + 1), F.lit(REACH)).alias("behind"),
        ),
    )
    # The running end of the previous candidate gives the starts, in a window over the row's own
    # candidates; growing an array of starts would take the square of their number.
    rows = rows.select("key", "path", F.monotonically_increasing_id().alias("row"), near.alias("near"))
    rows = rows.select("key", "path", "row", F.posexplode("near").alias("place", "one"))
    ends = F.sum(F.col("one.gap") + F.length("one.candidate")).over(Window.partitionBy("row").orderBy("place"))
    start = (ends - F.length("one.candidate")).cast("int").alias("start")
    return rows.select("key", "path", start, "one.candidate", "one.before", "one.behind")


def _count(pattern: str, of: Column | None = None) -> Column:
    return F.regexp_count(F.col("candidate") if of is None else of, F.lit(pattern)).cast("double")


def _words(of: Column) -> Column:
    return F.filter(F.split(F.lower(of), r"[^\p{L}]+"), lambda w: F.length(w) > 2)


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``run``: the words of three letters or more that are frequent in all whole texts."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}]+")).alias("run"))
    counts = words.filter(F.length("run") > 2).groupBy("run").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= MIN_WORD_COUNT).select("run")


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with the numbers in ``_NUMERIC`` and ``neighbours``, the words around.

    The letter runs of a candidate are looked up in the dictionary ``known`` by a join.
    """
    length = F.length("candidate").cast("double")
    c, before, behind = F.col("candidate"), F.col("before"), F.col("behind")
    runs = F.array_distinct(_words(c))
    rows = found.select(
        "*",
        length.alias("length"),
        (_count("[0-9]") / length).alias("digit_share"),
        (_count("[A-Z]") / length).alias("upper_share"),
        (_count("[0-9a-fA-F]") / length).alias("hex_share"),
        # Character transitions: between letters and digits, between cases, and unusual pairs.
        (_count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / length).alias("switches"),
        (_count("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / length).alias("case_switches"),
        (F.size(F.array_distinct(F.split(c, ""))) / length).alias("distinct_share"),
        F.array_max(F.transform(F.split(c, "[^A-Za-z]+"), F.length)).cast("double").alias("longest_letters"),
        (_count("(?i)(?=[bcdfghjklmnpqrstvwxz]{3})") / length).alias("rare_pairs"),
        # Path: separators in the candidate, and whether it stands in a path or an address.
        _count("/").alias("path_depth"),
        F.rlike(before, F.lit(r"[\w.]/$")).cast("double").alias("in_path"),
        F.rlike(before, F.lit(r"(://|@)\S*$")).cast("double").alias("in_address"),
        # Neighbouring words: assignments, quotes and keywords right before the candidate.
        F.rlike(before, F.lit(r"[=:]\s*[\"']?$")).cast("double").alias("assigned"),
        (F.rlike(before, F.lit("[\"']$")) & F.rlike(behind, F.lit("^[\"']"))).cast("double").alias("quoted"),
        F.rlike(before, F.lit(rf"(?i)({'|'.join(KEYWORDS)})\W{{0,4}}$")).cast("double").alias("announced"),
        F.concat(F.slice(F.reverse(_words(before)), 1, 3), F.slice(_words(behind), 1, 3)).alias("neighbours"),
        runs.alias("runs"),
    )
    rows = settle(rows, "candidates")
    # Each different run of a candidate counts once, so a repeated finding is one look-up.
    distinct = rows.select("candidate", "runs").distinct()
    covered = (
        distinct.select("candidate", F.explode("runs").alias("run")).join(known, "run", "left_semi")
        .groupBy("candidate").agg(F.sum(F.length("run")).cast("double").alias("covered"))
    )
    covered = settle(covered, "covered")
    share = F.least(F.coalesce("covered", F.lit(0.0)) / F.col("length"), F.lit(1.0))
    return rows.join(covered, "candidate", "left").withColumn("dictionary_share", share).drop("covered", "runs")


def weak_labels(rows: DataFrame) -> DataFrame:
    """Labelled findings where nobody has labelled any: sure ones of either kind.

    Secret: a well-known form, or a random-looking string that is assigned to a keyword.
    False: letters only, or a plain number, that no keyword announces. Others get no label.
    """
    form = F.rlike("candidate", F.lit(f"^({'|'.join(KNOWN_FORMS)})$"))
    random = (F.col("digit_share") > 0.2) & (F.col("switches") > 0.1)
    user = F.rlike("before", F.lit(r"://[^\s/:@]*:$"))
    secret = form | (((F.col("announced") == 1) | user) & (F.col("assigned") == 1) & random)
    false = (F.col("announced") == 0) & ~user & ((F.col("digit_share") == 0) | (F.col("digit_share") == 1))
    label = F.when(secret, 1.0).when(false & ~form, 0.0)
    return rows.withColumn("label", label).filter("label is not null")


def _sample(labelled: DataFrame, most: int) -> DataFrame:
    """The same number of both labels at most: different candidates with the smallest hashes."""
    one = labelled.groupBy("label", "candidate").agg(
        F.min(F.struct(*[F.col(c) for c in (*_NUMERIC, "neighbours")])).alias("row")
    )
    hashed = one.withColumn("hash", F.xxhash64("candidate"))
    halves = [hashed.filter(F.col("label") == v).orderBy("hash", "candidate").limit(most // 2) for v in (0.0, 1.0)]
    return halves[0].unionByName(halves[1]).select("label", "row.*")


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    path: str = "source",
    threshold: float = 0.5,
    most: int = FIT_ROWS,
) -> DataFrame:
    """Every candidate with its ``probability`` of being a secret, and ``is_secret``.

    Returns ``key``, ``start`` (characters from 0), ``length``, ``candidate``, ``probability``
    and ``is_secret``. ``findings`` are labelled ones: ``candidate`` and ``label`` (1 secret,
    0 false positive); without them, sure cases of both kinds are labelled by rule. The
    forest is fitted on ``most`` different labelled candidates and applied to all.

    A NULL or empty text has no candidates; a row without a path has an empty one. Repeated
    rows give their findings as often as they occur. If only one label occurs, every
    candidate has that label's probability; without any label it is NULL and ``is_secret``
    false. An empty table gives an empty result. Other columns are not read.
    """
    rows = settle(features(candidates(docs, key, text, path), dictionary(docs, text)), "features")
    if findings is None:
        labelled = weak_labels(rows)
    else:
        given = findings.groupBy("candidate").agg(F.max(F.col("label").cast("double")).alias("label"))
        labelled = rows.join(given, "candidate")
    train = settle(_sample(labelled, most), "train")
    labels = [r.label for r in train.select("label").distinct().collect()]  # two at most
    if len(labels) < 2:
        sure = F.lit(labels[0] if labels else None).cast("double")
        judged = rows.withColumn("probability", sure)
    else:
        hashed = HashingTF(inputCol="neighbours", outputCol="near", numFeatures=NEIGHBOUR_BUCKETS, binary=True)
        gathered = VectorAssembler(inputCols=[*_NUMERIC, "near"], outputCol="features")
        forest = RandomForestClassifier(numTrees=30, maxDepth=6, seed=17, probabilityCol="chances")
        model = Pipeline(stages=[hashed, gathered, forest]).fit(train)
        judged = model.transform(rows).withColumn("probability", vector_to_array("chances")[1])
    return judged.select(
        F.col("key").alias(key),
        "start",
        F.col("length").cast("int").alias("length"),
        "candidate",
        "probability",
        F.coalesce(F.col("probability") >= threshold, F.lit(False)).alias("is_secret"),
    )
