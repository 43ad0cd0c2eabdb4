"""Secret scan with a random forest that removes false findings, DataFrame functions and Spark ML only.

Candidates, in every line:

* each run of at least ``MIN_CHARS`` characters of ``[A-Za-z0-9+/_@.-]`` with a
  digit, and each word with one as a whole, whatever its characters;
* each word of at least ``MIN_CHARS`` characters, digit or not, after an
  assignment sign or up to three words after a credential word;
* what is assigned to a credential word, at any length; in quotes it may be
  several words (at most ``PHRASE``), put together with single blanks;
* each run that starts with a known key prefix.

A word is taken without a name and sign before it and without the brackets,
quotes and ``, . ; :`` around it. A passphrase of several words without quotes
is found word by word. The features of a finding: length;
character statistics and transitions between character classes; the share
covered by dictionary words; whether it looks like or stands in a path, an
address or a number; the words around it (a credential word up to three words
before, an assignment sign, quotes, ordinary words on either side). A forest
trained on labelled findings gives each candidate its probability of being a
secret; below ``THRESHOLD`` it is removed as false.

Labels: ``train`` takes findings with a ``label`` column (1.0 secret, 0.0
not). Where a corpus brings none, ``weak_labels`` labels the clear cases (a
key id with its fixed prefix, a random string or one with signs assigned to a
credential word, a quoted string assigned to a password word; against them plain numbers, addresses, dotted numbers and
ordinary words) and leaves the rest
unlabelled for the forest. At most ``MAX_LABELLED`` findings train it, up to half
of them of each label, those with the least hashes; both labels weigh the same
in all, so rare secrets train it however many clear negatives stand beside them. The dictionary is the ``WORDS`` most frequent words of
3 to 8 letters in the whole corpus.

Scale: lines that cannot hold a candidate are dropped inside the scan; findings
are narrow rows scored in place. The only shuffles are the word counts, summed
before it, and the bounded training sample.

Defined cases: null and empty texts have no findings; null ids are kept;
repeated rows are scanned each; without labels of both kinds every finding
scores their share of secrets (0.5 without any); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import cut, source

MIN_CHARS = 8
WORDS = 300
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 30, 6, 7
THRESHOLD = 0.5
#: Words of a quoted passphrase, at most.
PHRASE = 32

#: Words that announce a credential.
CREDENTIAL = "(?i)(pass(word|wd|phrase)?|secret|token|api[_-]?key|key|auth|credential|bearer)"
#: A credential word with its sign (three groups), and starts of keys of known services.
ASSIGNED = CREDENTIAL + r"[\w.-]{0,40}[\"'`]?([=:]+>?)"
PREFIXED = "(?<![A-Za-z0-9])(?:AKIA|ASIA|gh[pousr]_|github_pat_|xox[abprs]-|sk[-_]|AIza)[A-Za-z0-9_-]{7,}[A-Za-z0-9]"

FEATURES = [
    "f_length", "f_digits", "f_upper", "f_lower", "f_hex", "f_distinct", "f_turns", "f_letter_digit", "f_case",
    "f_dictionary", "f_number", "f_dotted", "f_address", "f_path", "f_credential", "f_assigned", "f_quoted", "f_before_word", "f_after_word",
]


def dictionary(df: DataFrame, text_col: str = "text", size: int = WORDS) -> list[str]:
    """The most frequent words of 3 to 8 letters a-z; ties in order of the word."""
    word = df.select(F.explode(F.split(F.col(text_col).cast("string"), r"[\x20\x09-\x0D]+")).alias("word")).where(F.col("word").rlike("^[a-z]{3,8}$"))
    top = word.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [r["word"] for r in top.collect()]  # at most ``size``


def _share(pattern: str, of: str = "finding") -> Column:
    return F.regexp_count(of, F.lit(pattern)) / F.char_length(of)


def _trimmed(word: Column) -> Column:
    return F.regexp_replace(word, "^[(\\[{<\"'`]+|[)\\]}>\"'`,.;:]+$", "")


def _candidates() -> Column:
    """Candidates of the word ``here``: the runs with a digit in their order (null for other runs), then the others."""
    runs = F.transform(F.regexp_extract_all("here", F.lit(f"[A-Za-z0-9+/_@.-]{{{MIN_CHARS},}}"), F.lit(0)), lambda x: F.regexp_replace(x, "[.-]+$", ""))
    runs = F.transform(runs, lambda x: F.when(x.rlike("[0-9]") & (F.char_length(x) >= MIN_CHARS), x))
    body = F.when(F.col("given"), F.col("here")).otherwise(F.regexp_replace("here", "^[(\\[{<\"'`]*[A-Za-z_][\\w.-]{0,60}[\"'`]?[=:]+>?(?!/)", ""))
    whole = _trimmed(body)
    wanted = F.col("given") | ((F.char_length(whole) >= MIN_CHARS) & (whole.rlike("[0-9]") | F.col("called") | (body != F.col("here"))))
    assigned = F.transform(F.regexp_extract_all("here", F.lit(ASSIGNED + "(\"[^\"]+|'[^']+|`[^`]+|[^\"'`]+)"), F.lit(4)), _trimmed)
    # quoted: in this word after its sign, or as a whole after the sign before it; may end in a later word
    opened = F.concat(F.when(F.col("given"), "key=").otherwise(""), F.when(F.col("here").rlike("[\"'`]"), F.col("rest")).otherwise(""))
    quoted = F.regexp_extract(opened, "^\\S*?" + ASSIGNED + "[(\\[{]*([\"'`])(.*?)\\4", 5)
    others = F.concat(F.array(F.when(wanted, whole), quoted), assigned, F.regexp_extract_all("here", F.lit(PREFIXED), F.lit(0)))
    return F.concat(runs, F.array_except(F.filter(others, lambda x: x.rlike("[^=:>]")), runs))


def findings(df: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line, word (numbers from 0), part (of the word), finding and the features of every candidate."""
    lines = source(df, id_col, text_col).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    lines = lines.where(F.col("content").rlike("[0-9=:]") | F.col("content").rlike(CREDENTIAL) | F.col("content").rlike(PREFIXED))
    split = lines.select("doc_id", "line", F.split("content", r"[\x20\x09-\x0D]+").alias("w"))
    # each word with its neighbours is made, and dropped, inside the line's array, so that no row of a word holds the line
    at = lambda i: F.coalesce(F.get("w", i), F.lit(""))
    words_of = F.transform("w", lambda x, i: F.struct(i.alias("word"), x.alias("here"), at(i - 1).alias("b1"), at(i - 2).alias("b2"), at(i - 3).alias("b3"), at(i + 1).alias("a1")))
    some = lambda x: (x["here"] != "") & (
        x["here"].rlike("[0-9=:]") | x["b1"].rlike("[=:]>?$") | F.concat_ws(" ", x["b3"], x["b2"], x["b1"]).rlike(CREDENTIAL) | x["here"].rlike(PREFIXED)
    )
    rest = lambda x: F.array_join(F.slice("w", x["word"] + 1, PHRASE), " ")
    kept = F.transform(F.filter(words_of, some), lambda x: F.struct(x.alias("x"), rest(x).alias("rest")))
    near = split.select("doc_id", "line", F.explode(kept).alias("k")).select("doc_id", "line", "k.x.*", "k.rest")
    after = F.concat_ws(" ", "b3", "b2", "b1").rlike(CREDENTIAL)
    given = F.col("b1").rlike(ASSIGNED + "$") | (F.col("b1").rlike("^[=:]+>?$") & F.col("b2").rlike(CREDENTIAL))
    near = near.withColumns({"given": given, "called": F.col("b1").rlike("[=:]>?$") | after})
    runs = near.withColumn("runs", _candidates())
    each = runs.select("*", F.posexplode("runs").alias("part", "finding")).where("finding is not null").drop("runs", "rest")
    head = F.substring_index("finding", " ", 1)  # of a passphrase, the word that stands here
    left = F.substring("here", F.lit(1), F.instr("here", head) - 1)
    right = F.when(F.col("finding").contains(" "), "'").otherwise(F.substring("here", F.instr("here", head) + F.char_length("finding"), F.lit(8)))
    covered = F.regexp_replace(F.lower("finding"), "(" + "|".join(sorted(words, key=lambda x: (-len(x), x))) + ")", "") if words else F.col("finding")
    flag = lambda c: c.cast("double")
    word = "^[^0-9=:\"'#$&*%]+$"
    return each.withColumns({"left": left, "right": right}).select(
        "doc_id", F.col("line").cast("bigint"), F.col("word").cast("bigint"), F.col("part").cast("bigint"), "finding", "left", "b1", "b2",
        F.char_length("finding").cast("double").alias("f_length"), _share("[0-9]").alias("f_digits"), _share("[A-Z]").alias("f_upper"), _share("[a-z]").alias("f_lower"),
        _share("[0-9a-f]").alias("f_hex"), (F.size(F.array_distinct(F.split("finding", ""))) / F.char_length("finding")).alias("f_distinct"),
        _share("[A-Za-z](?=[^A-Za-z])|[0-9](?=[^0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])").alias("f_turns"), _share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])").alias("f_letter_digit"),
        _share("[a-z](?=[A-Z])|[A-Z](?=[a-z])").alias("f_case"), (1 - F.char_length(covered) / F.char_length("finding")).alias("f_dictionary"),
        flag(F.col("finding").rlike(r"^[0-9+.\-]+$")).alias("f_number"), flag(F.col("finding").rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")).alias("f_dotted"),
        flag(F.col("finding").contains("@")).alias("f_address"), flag(F.col("here").rlike("(://|/.*/|^/|^[.]{1,2}/|\\.[a-z]{2,4}$)")).alias("f_path"),
        flag(F.concat_ws(" ", "b3", "b2", "b1", "left").rlike(CREDENTIAL)).alias("f_credential"), flag(F.col("left").rlike("[=:]") | F.col("b1").rlike("[=:]$")).alias("f_assigned"),
        flag(F.col("left").rlike("[\"'`]$") & F.col("right").rlike("^[\"'`]")).alias("f_quoted"), flag(F.col("b1").rlike(word)).alias("f_before_word"), flag(F.col("a1").rlike(word)).alias("f_after_word"),
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """The clear cases with their label."""
    random = F.col("finding").rlike("^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_-]{16,}$")
    signs = F.col("finding").rlike("^(?=.*[0-9])(?=.*[A-Za-z])(?=.*[!$%&*#^?~])[^$%&*#][^\\s()\\[\\]{}<>\"'`;,]{7,}$")
    secret = F.col("finding").rlike("^AKIA[A-Z0-9]{16}$") | ((random | signs) & (F.col("f_credential") == 1) & (F.col("f_assigned") == 1))
    literal = F.concat_ws(" ", "b2", "b1", "left").rlike("(?i)pass(word|wd|phrase)[\\w.-]*[\"'`]?\\s*[=:]+>?\\s*[(\\[{]*[\"'`]$") & (F.col("f_quoted") == 1) & (F.col("f_length") >= MIN_CHARS)
    secret = secret | literal
    # ordinary words: without a credential word, or amid a sentence that has one
    amid = (F.col("f_assigned") == 0) & (F.col("f_quoted") == 0) & (F.col("f_before_word") == 1) & (F.col("f_after_word") == 1) & ~F.col("b1").rlike("(?i)^(is|was|are|be)$")
    plain = F.col("finding").rlike("^\\p{L}\\p{Ll}+$") & ((F.col("f_credential") == 0) | amid)
    clean = (F.col("f_credential") == 0) & (F.col("f_assigned") == 0) & ((F.col("f_number") == 1) | (F.col("f_address") == 1) | (F.col("f_path") == 1) | (F.col("f_dictionary") > 0.5)) | plain
    return found.withColumn("label", F.when(secret, 1.0).when(clean, 0.0)).where("label is not null")


def train(labelled: DataFrame, most: int = MAX_LABELLED) -> RandomForestClassificationModel | float:
    """The forest, or the share of secrets where all labels are of one kind."""
    rows = labelled.select("label", *FEATURES, F.xxhash64("finding", "doc_id", "line", "word", "part").alias("order"))
    least = [rows.where(F.col("label") == label).orderBy("order").limit(most // 2) for label in (0.0, 1.0)]
    sample = cut(least[0].union(least[1]))
    # a label with any row has rows in the sample, so this holds for the whole set
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return max(counts, default=0.5)
    even = F.when(F.col("label") == 1, max(counts.values()) / counts[1.0]).otherwise(max(counts.values()) / counts[0.0])
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features", weightCol="weight")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.withColumn("weight", even).orderBy("order")))


def score(found: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    """found with ``score``, the forest's probability of a secret."""
    if isinstance(model, float):
        return found.withColumn("score", F.lit(model))
    made = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    return made.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def scan(df: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, line, word, part, finding, score and is_secret of every candidate in every text."""
    found = findings(df, dictionary(df, text_col), id_col, text_col)
    out = score(found, train(weak_labels(found) if labelled is None else labelled))
    return out.select("doc_id", "line", "word", "part", "finding", "score", (F.col("score") >= threshold).alias("is_secret"))
