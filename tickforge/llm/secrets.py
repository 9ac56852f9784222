"""Secret scan with a random forest against false positives.  DataFrame
functions and ``pyspark.ml`` only.

Candidates are runs of at least ``MIN_CHARS`` characters of
``[A-Za-z0-9_+/=-]`` in whole texts, with the words around them; where a
credential word and an assignment sign stand before, in the word or in the one
or two words before it, or in an address with user name and password,
``SHORT_CHARS`` are enough.  Features of a
candidate: length; shares of digits, capitals and hex digits; number of
distinct characters; transitions between letters of either case, digits and
other characters; dictionary coverage (share of its characters in runs of
letters that are words of the corpus, found in at least ``MIN_DOCS``
documents); its own path look (slashes, dots and colons around it); the path
or source it was found under (a hash bucket and test or example words); the
neighbouring words (credential words, an assignment sign, quotes, dictionary
coverage of the word before).  A random forest is fitted on labelled findings,
``MAX_TRAIN`` of them at most, and scores every candidate.

A null or empty text has no candidates, a null path is an empty one.  Without
findings of both labels the score of every candidate is the share of positive
labels (0 without labels).  Null labels are ignored.  Repeated rows are
reported each.  Of reviewed findings with different labels for one secret none
counts.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import LAST_ID, public_id, written

MIN_CHARS = 16
SHORT_CHARS = 8
MIN_DOCS = 3
MAX_TRAIN = 20000
TREES, DEPTH = 20, 6
PATH_BUCKETS = 64
THRESHOLD = 0.5
RUN = f"[A-Za-z0-9_+/=-]{{{MIN_CHARS},}}"
#: Words that stand before credentials, and in paths of samples.
CREDENTIAL_WORDS = "(?i)(token|secret|passw|pwd|api.?key|access.?key|credential|auth|bearer|private)"
SAMPLE_WORDS = "(?i)(test|example|sample|mock|fixture|doc)"
#: Published formats of access keys and tokens.
PUBLISHED = ("^AKIA[0-9A-Z]{16}$", "^gh[pousr]_[A-Za-z0-9]{36}$", "^xox[abprs]-[A-Za-z0-9-]{20,}$", "^AIza[A-Za-z0-9_-]{35}$",
             "^(sk|rk)_live_[A-Za-z0-9]{24,}$", "^npm_[A-Za-z0-9]{36}$", "^glpat-[A-Za-z0-9_-]{20}$", "^eyJ[A-Za-z0-9_-]{20,}$")
SHORT_RUN = f"[A-Za-z0-9_+/=-]{{{SHORT_CHARS},}}"
#: User name and password in an address.
USER_PART = "://[^/@:]*:[^/@]*@"
#: A credential word, the rest of the name, an assignment sign.
NAMED = CREDENTIAL_WORDS + "[A-Za-z0-9_.\\]'\"-]*[ \\t\\n\\x0B\\f\\r]*[=:]"

FEATURES = ["f_length", "f_digits", "f_capitals", "f_hex", "f_distinct", "f_transitions", "f_dictionary", "f_slashes",
            "f_around", "f_path", "f_sample", "f_credential", "f_assigned", "f_quoted", "f_before"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """(id, path, word_no, run_no, run, word, before1, before2, after1): every
    candidate with its word and neighbours; word_no counts the words of the
    text (split at white space) and run_no the runs of the word, from 0."""
    path = F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"), path.alias("path"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    words = rows.where(F.col("text").rlike(RUN) | F.col("text").rlike(NAMED) | F.col("text").rlike(USER_PART)).select(
        "id", "path", F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), r"[ \t\n\x0B\f\r]+").alias("w"))

    def near(i: Column) -> Column:
        return F.coalesce(F.get(F.col("w"), i), F.lit(""))

    def named(word: Column, before1: Column, before2: Column) -> Column:
        return (before1.rlike("[=:]$") & F.concat_ws(" ", before2, before1).rlike(CREDENTIAL_WORDS)) \
            | (word.rlike("[=:]") & (word.rlike(NAMED) | word.rlike(USER_PART)))

    def some(i: Column) -> Column:
        word = F.get(F.col("w"), i)
        return (F.length(word) >= SHORT_CHARS) & word.rlike(SHORT_RUN) & (
            word.rlike(RUN) | named(word, near(i - 1), near(i - 2)))

    numbers = F.filter(F.sequence(F.lit(0), F.size("w") - 1), some)
    hits = F.transform(numbers, lambda i: F.struct(
        i.alias("word_no"), F.get(F.col("w"), i).alias("word"), near(i - 1).alias("before1"),
        near(i - 2).alias("before2"), near(i + 1).alias("after1")))
    each = words.select("id", "path", F.inline(hits))
    runs = F.regexp_extract_all("word", F.lit(RUN), F.lit(0))
    # a name and its sign are no value
    short = F.filter(F.regexp_extract_all("word", F.lit(SHORT_RUN), F.lit(0)),
                     lambda r: (F.length(r) >= MIN_CHARS) | ~r.rlike(CREDENTIAL_WORDS + "[A-Za-z_-]*=*$"))
    own = F.when(named(F.col("word"), F.col("before1"), F.col("before2")), short).otherwise(runs)
    return each.select("*", F.posexplode(own).alias("run_no", "run"))


def dictionary(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(part): words of three letters at least, in ``min_docs`` documents."""
    word = F.regexp_extract_all(F.lower(F.col(f"`{text_col}`").cast("string")),
                                F.lit(r"(?<![\p{L}0-9])\p{L}{3,}(?![\p{L}0-9])"), F.lit(0))
    return docs.select(F.explode(F.array_distinct(word)).alias("part")).groupBy("part") \
        .agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("part")


def _share(run: Column, keep: str) -> Column:
    return F.length(F.regexp_replace(run, f"[^{keep}]", "")) / F.greatest(F.length(run), F.lit(1))


def coverage(strings: DataFrame, words: DataFrame) -> DataFrame:
    """(s, covered) of distinct strings (s): share of the characters in runs of
    letters that are words."""
    parts = strings.select("s", F.explode(F.regexp_extract_all(F.lower("s"), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("part"))
    return parts.join(words, "part").groupBy("s").agg(
        (F.sum(F.length("part")) / F.greatest(F.length("s"), F.lit(1))).alias("covered"))


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with their features."""
    covered = written(coverage(found.select(F.col("run").alias("s")).union(found.select(F.col("before1").alias("s")))
                               .distinct(), words), "secret-coverage")
    rows = found.join(covered.select(F.col("s").alias("run"), F.col("covered").alias("f_dictionary")), "run", "left") \
        .join(covered.select(F.col("s").alias("before1"), F.col("covered").alias("f_before")), "before1", "left")
    run = F.col("run")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        run, "[_+/=-]+", "."), "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    around = F.length(F.regexp_replace(F.replace(F.col("word"), run, F.lit("")), "[^./:@#?&]", ""))
    before = F.concat_ws(" ", "before2", "before1")
    return rows.select(
        "*", F.length(run).cast("double").alias("f_length"), _share(run, "0-9").alias("f_digits"),
        _share(run, "A-Z").alias("f_capitals"), _share(run, "0-9a-f").alias("f_hex"),
        F.size(F.array_distinct(F.split(run, ""))).cast("double").alias("f_distinct"),
        ((F.length(kinds) - 1) / F.greatest(F.length(run) - 1, F.lit(1))).alias("f_transitions"),
        F.length(F.regexp_replace(run, "[^/]", "")).cast("double").alias("f_slashes"), around.cast("double").alias("f_around"),
        F.pmod(F.xxhash64("path"), F.lit(PATH_BUCKETS)).cast("double").alias("f_path"),
        F.col("path").rlike(SAMPLE_WORDS).cast("double").alias("f_sample"),
        F.concat_ws(" ", before, "word").rlike(CREDENTIAL_WORDS).cast("double").alias("f_credential"),
        (F.col("before1").rlike("[=:]$") | F.col("word").rlike("[=:]['\"]?" + RUN)).cast("double").alias("f_assigned"),
        F.col("word").rlike("[\"'`]").cast("double").alias("f_quoted"),
    ).fillna(0.0, ["f_dictionary", "f_before"])


def fit_and_score(rows: DataFrame, label: Column, max_train: int = MAX_TRAIN, trees: int = TREES, depth: int = DEPTH,
                  seed: int = 7) -> DataFrame:
    """The rows with a ``score``, of a forest fitted on those with a label
    (boolean; null for none)."""
    marked = rows.withColumn("label", label.cast("double"))
    known = marked.where("label is not null")
    n, positive = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < positive < n:
        return rows.withColumn("score", F.lit(float(positive / n) if n else 0.0))
    # each label gives at most half of the sample
    shares = {1.0: positive, 0.0: n - positive}
    picked = F.lit(False)
    for value, count in shares.items():
        share = min(1.0, max_train / 2 / count)
        here = F.pmod(F.xxhash64("id", "word_no", "run_no", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
        picked = picked | ((F.col("label") == value) & here)
    to_vector = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    sample = written(known.where(picked).select("label", *FEATURES), "secret-sample").limit(max_train)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    model = forest.fit(to_vector.transform(sample))
    scored = model.transform(to_vector.transform(rows))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def known_format(word: Column, run: Column, before: Column) -> Column:
    """Labels of findings whose format settles the matter, null for others.

    True for the ``PUBLISHED`` formats; for a hex string of 32 to 64 digits
    that is quoted after an equals sign, or assigned with ``=`` or ``:`` to a
    credential word, in one word or two; for what stands between user name and
    host in an address, or in a query parameter named by a credential word, if
    it has letters and digits.  False for digits only, letters only, separators
    only, and other mail, path or address parts."""
    mark = "\u0001"
    shape = F.replace(word, run, F.lit(mark))
    digits, letters = run.rlike("[0-9]"), run.rlike("[A-Za-z]")
    hex_value = (run.rlike("^[0-9a-f]{32,64}$") | run.rlike("^[0-9A-F]{32,64}$")) & digits & letters
    published = reduce(lambda a, x: a | run.rlike(x), PUBLISHED[1:], run.rlike(PUBLISHED[0]))
    quoted = (before == "=") & word.rlike("^['\"]")
    assigned = shape.rlike(CREDENTIAL_WORDS + f"[A-Za-z0-9_.'\"-]*[=:]['\"]?{mark}") \
        | (before.rlike(CREDENTIAL_WORDS + "[A-Za-z0-9_.'\"-]*[=:]$") & shape.rlike(f"^['\"]?{mark}"))
    in_address = shape.rlike(f"://[^/@:]*:{mark}@") | shape.rlike("[?&][^=&]*" + CREDENTIAL_WORDS + f"[^=&]*={mark}")
    plain = run.rlike("^[0-9]+$") | run.rlike("^[A-Za-z]+$") | run.rlike("^[_+/=-]+$") | word.rlike("@|://|^/")
    return F.when(published | (hex_value & (quoted | assigned)) | (in_address & digits & letters), True).when(plain, False)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
         label=known_format, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN, min_docs: int = MIN_DOCS,
         reviewed: DataFrame | None = None) -> DataFrame:
    """(doc_id, word_no, run_no, secret, score, is_secret): every candidate.

    ``reviewed`` (secret, is_secret) has labelled findings; for all others
    ``label(word, run, word before)`` gives a candidate's label, or null.
    """
    found = written(candidates(docs, id_col, text_col, path_col), "secret-candidates")
    rows = written(featured(found, written(dictionary(docs, text_col, min_docs), "secret-words")), "secret-features")
    own = label(F.col("word"), F.col("run"), F.col("before1"))
    if reviewed is not None:
        seen = reviewed.select(F.col("secret").alias("run"), F.col("is_secret").cast("boolean").alias("reviewed")) \
            .groupBy("run").agg(F.min("reviewed").alias("reviewed"), F.max("reviewed").alias("most")) \
            .where("reviewed = most").drop("most")
        rows = rows.join(seen, "run", "left")
        own = F.coalesce(F.col("reviewed"), own)
    scored = fit_and_score(rows, own, max_train)
    return scored.select(public_id().alias(id_col), F.col("word_no").cast("long").alias("word_no"),
                         F.col("run_no").cast("long").alias("run_no"), F.col("run").alias("secret"), "score",
                         (F.col("score") >= threshold).alias("is_secret"))
