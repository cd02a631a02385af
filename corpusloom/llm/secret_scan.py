"""Secrets in texts: candidates by shape, false positives removed by a random forest.

All of it is DataFrame operations and `pyspark.ml`. A candidate is a word that holds a long run of
key characters with a digit, a known key prefix, a value after a secret name with = or :, or the password of a URL,
of any length. A value ends at white space. Every run of the word is judged by itself, with what
precedes it; a dotted `eyJ` token is one value. The forest sees the length of
the run, the changes between character classes, how much of it dictionary words cover, the
path of the document and the words around it. It learns from labelled findings: those of the
corpus whose format or context settles what they are, and generated
examples of both kinds, so that it is never without either.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACE, external_key, internal_key, quoted, unused, written

LEAST = 16
TREES, DEPTH, SEED = 40, 8, 5
#: Bounds on the labelled findings that the forest is fitted on.
MAX_LABELLED, GENERATED = 100_000, 6_000
MARK = "[SECRET]"
_KEY = "A-Za-z0-9+/_-"
_RUN = rf"[{_KEY}]{{{LEAST},}}"
# -- fixed values: public key formats and the words that tell ----------------
PREFIXES = r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abpr]-|sk-|sk_live_|AIza|eyJ)"
SECRET_NAMES = r"(?i)(secret|token|passw|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth)"
HARMLESS_NAMES = r"(?i)(commit|sha1|sha256|md5|checksum|digest|uuid|guid|hash|revision|example|sample|dummy|card|phone|order|invoice|isbn)"
HARMLESS_PATHS = r"(?i)(^|[/_.-])(tests?|examples?|samples?|fixtures?|docs?|mocks?)([/_.-]|$)"
DICTIONARY = (
    "about access account action address admin after again all and any api app apple are array auth back base before begin between block body box button call case change "
    "char check child class client close cloud code color column common config connect content context control copy count create current data date day default delete "
    "device direct display document down each edit email end entry error event example false field file filter final find first flag for form format from function get "
    "group handler have header here home host http image index info init input item job key label last left length level limit line link list load local log main make "
    "map message method model module name new next node not null number object offset open option order page panel param parent password path place point position post "
    "print process product project public query read record request reset response result return right role root row rule run sample save search select server service "
    "session set size sort source start state status step stop store string style system table tag target task test text the this time title token total tree type "
    "update upload url user value version view web width window with word work write your"
).split()
# ----------------------------------------------------------------------------
#: A dotted token (header, payload, signature) is one value, so is every run.
_JWT = r"eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*)+(?<!\.)"
_NAMED = SECRET_NAMES.removeprefix("(?i)").replace("(", "(?:", 1)
_PREFIXED = rf"(?<![A-Za-z0-9]){PREFIXES.removeprefix('^').replace('(', '(?:', 1)}[{_KEY}]+"
_QUOTE = r"[\\\"'`]"
#: From the end of a name to its value: `":"`, `=`, ` := ` and the like.
_JOINT = rf"{_QUOTE}*\]?(?::=|=>|[=:]+){_QUOTE}*"
#: The value after a name: up to a quote, to what begins another value, or to the stops at the word's end.
_END = rf"[.,;:!?&|)}}\]>]*{_QUOTE}*[.,;:!?&|)}}\]>]*$"
_NEXT = rf"[,;&|)}}\]]+[{{\[\"' ]*(?:[\w.-]+[\"']?[=:]|[{_KEY}]{{{LEAST}}})"
_VALUE = rf"(?![{{\[(]*$)(?:(?!{_END}|{_NEXT})[^\s\"'`\x01])+"
#: A name; one that may itself be a key (a run with a digit) is a value of its own.
_NAME = rf"[{_KEY}]*(?i:{_NAMED})[\w-]*"
_URL = r"://[^\s/@:\x01]*:"
VALUES = rf"({_URL})()()([^\s/@\x01]+(?=@))|()(?=[{_KEY}]*[0-9])(?=[{_KEY}]{{{LEAST}}})({_NAME})({_JOINT})({_VALUE})|()()({_NAME}{_JOINT})({_VALUE})|()()()({_JWT}|{_RUN}|{_PREFIXED})"
#: A word that a name before it makes a value: `password: x`, `token = x`.
NAME_BEFORE, SIGN_BEFORE, NAME_FIRST = rf"(?i:{_NAMED})[\w-]*{_JOINT}$", rf"^(?::=|=>|[=:]+){_QUOTE}*$", rf"(?i:{_NAMED})[\w-]*{_QUOTE}*\]?$"
_WORDS = "(" + "|".join(sorted((w for w in DICTIONARY if len(w) > 3), key=lambda w: (-len(w), w))) + ")"
#: Never in a word once it has been replaced by a blank; stands around the values.
_CUT = "\x01"
CANDIDATE = rf"(?<!\S)(?:(?=\S*[0-9])\S*[{_KEY}]{{{LEAST}}}|\S*(?:AKIA|ASIA)[A-Z0-9]{{16}})|{_PREFIXED}|(?i:{_NAMED})[\w-]*{_JOINT}[^\s\"'`]|{_URL}[^\s/@]+@"
#: A text that holds a candidate, or a name with a sign and white space before its value.
HOLDS = rf"{CANDIDATE}|(?i:{_NAMED})[\w-]*{_QUOTE}*\]?{SPACE[:-1]}*(?::=|=>|[=:]+)"
NUMBERS = (
    "length", "digit_share", "upper_share", "vowel_share", "class_changes", "distinct_share", "longest_letters", "dictionary_share",
    "is_hex", "is_number", "is_uuid", "has_prefix", "is_assigned", "symbol_share", "is_reference", "is_word", "in_url", "is_quoted", "secret_name", "harmless_name", "harmless_path", "path_depth",
)


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = "source") -> DataFrame:
    """key, row, word_at, word, before2, before, after, path: one row per candidate word; nothing is shuffled.

    `row` is a fingerprint of the id and the text: rows that repeat an id, or have none, differ in it.
    """
    path = F.coalesce(F.col(quoted(path_column)).cast("string"), F.lit("")) if path_column in docs.columns else F.lit("")
    texts = docs.select(
        internal_key(F.col(quoted(id_column))).alias("key"), row_print(id_column, text_column).alias("row"), F.col(quoted(text_column)).alias("text"), path.alias("path")
    )
    words = texts.filter(F.col("text").rlike(HOLDS)).select("key", "row", "path", F.split(F.trim(F.regexp_replace("text", SPACE, " ")), " ").alias("words"))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).rlike(CANDIDATE) | names_next(*(F.coalesce(F.get("words", i - k), F.lit("")) for k in (2, 1))))
    each = words.select("key", "row", "path", "words", F.explode(at).alias("word_at"))
    near = lambda step: F.coalesce(F.get("words", F.col("word_at") + step), F.lit(""))
    return each.select("key", "row", "word_at", near(0).alias("word"), near(-2).alias("before2"), near(-1).alias("before"), near(1).alias("after"), "path")


def names_next(before2: Column, before: Column) -> Column:
    """Whether the words before say that a secret follows."""
    return before.rlike(NAME_BEFORE) | (before.rlike(SIGN_BEFORE) & before2.rlike(NAME_FIRST))


def row_print(id_column: str, text_column: str) -> Column:
    return F.xxhash64(internal_key(F.col(quoted(id_column))), F.col(quoted(text_column)))


def valued(found: DataFrame) -> DataFrame:
    """`found` with a row for each value of each word: value_at, value, inside and name.

    `inside` is what stands in the word between the value before and this one; `name` is where a name for the value is
    looked for: there, and for the first value of a word, or where only signs stand between, in all that precedes.
    """
    word, given = F.translate("word", _CUT, " "), names_next(F.col("before2"), F.col("before"))
    groups = [[f"${1 + 4 * k + g}" for k in range(4)] for g in range(4)]
    marked = "".join("".join(g) + _CUT for g in groups)
    # A name in the words before is put before the word and taken away again.
    cut = F.split(F.regexp_replace(F.when(given, F.concat(F.lit("token="), word)).otherwise(word), VALUES, marked), _CUT)
    cut = F.when(given, F.transform(cut, lambda c, i: F.when(i < 3, F.regexp_replace(c, "^token=", "")).otherwise(c))).otherwise(cut)
    whole = F.array(F.lit(""), F.lit(""), F.lit(""), word, F.lit(""))
    found = found.withColumn("cut", F.when(F.size(cut) > 4, cut).otherwise(whole))
    ats = F.filter(F.sequence(F.lit(1), F.size("cut") - 1, F.lit(2)), lambda i: F.get("cut", i) != "")
    found = found.withColumn("value_at", F.explode(ats))
    at = F.col("value_at")
    begin = (F.floor(at / 4) * 4).cast("int")
    inside = F.array_join(F.slice("cut", begin + 1, at - begin), "")
    ahead = F.concat_ws(" ", F.col("before2"), F.col("before"), F.array_join(F.slice("cut", 1, at), ""))
    found = found.withColumns({"value": F.get("cut", at), "inside": inside})
    alone = (begin > 0) & F.col("inside").rlike("[A-Za-z]")
    return found.withColumn("name", F.when(alone, F.col("inside")).otherwise(ahead)).drop("cut")


def described(found: DataFrame) -> DataFrame:
    """`found` with every value of each word and the numbers the forest sees."""
    found = valued(found)
    v, n = F.col("value"), F.length("value")
    count = lambda pattern: n - F.length(F.regexp_replace(v, pattern, ""))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    inside, name = F.col("inside"), F.col("name")
    flag = lambda c: c.cast("double")
    letters = F.transform(F.regexp_extract_all(v, F.lit("([A-Za-z]+)")), F.length)
    numbers: dict[str, Column] = {
        "length": n.cast("double"),
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "vowel_share": count("[aeiouAEIOU]") / n,
        "class_changes": (F.length(F.regexp_replace(classes, r"(.)\1*", "x")) - 1) / n,
        "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / n,
        "longest_letters": F.coalesce(F.array_max(letters), F.lit(0)) / n,
        "dictionary_share": (n - F.length(F.regexp_replace(F.lower(v), _WORDS, ""))) / n,
        "is_hex": flag(v.rlike("^[0-9a-f]+$")),
        "is_number": flag(v.rlike("^[0-9-]+$")),
        "is_uuid": flag(v.rlike("(?i)^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$")),
        "has_prefix": flag(v.rlike(PREFIXES)),
        "is_assigned": flag(inside.rlike("[=:]") | ((F.col("value_at") < 4) & F.col("before").rlike("[=:]$"))),
        "symbol_share": count(rf"[^{_KEY}]") / n,
        "is_reference": flag(v.rlike(r"^[<$%{*x.]|[(\[{]|[.](?:get|env)|[*]{3}")),
        "is_word": flag(v.rlike("^(?:[A-Z]?[a-z]+|[A-Z]+)[.,;:!?]*$")),
        "in_url": flag(inside.rlike("://[^/]*:$")),
        "is_quoted": flag(F.col("word").rlike("[\"'`]")),
        "secret_name": flag(name.rlike(SECRET_NAMES)),
        "harmless_name": flag(name.rlike(HARMLESS_NAMES)),
        "harmless_path": flag(F.col("path").rlike(HARMLESS_PATHS)),
        "path_depth": F.size(F.split("path", "/")).cast("double"),
    }
    return found.withColumns(numbers)


def settled(found: DataFrame) -> DataFrame:
    """Findings that format or context settle, with `label`; the others are left out."""
    long = (F.col("length") >= LEAST) & (F.col("digit_share") > 0) & (F.col("symbol_share") == 0)
    secret = ((F.col("has_prefix") == 1) & (F.col("length") >= LEAST)) | (long & (F.col("is_assigned") == 1) & (F.col("secret_name") == 1) & (F.col("is_number") == 0))
    harmless = (F.col("is_number") == 1) | (F.col("is_uuid") == 1) | ((F.col("harmless_name") == 1) & (F.col("secret_name") == 0))
    harmless = harmless & ((F.col("length") >= LEAST) | (F.col("secret_name") == 0))
    label = F.when(secret & (F.col("harmless_name") == 0), 1.0).when(harmless & ~secret, 0.0)
    return found.withColumn("label", label).filter("label IS NOT NULL")


def generated(spark: SparkSession, rows: int = GENERATED) -> DataFrame:
    """Labelled examples of both kinds in the columns of `candidates`, made from hashes of row numbers."""
    h = "sha1(concat('example', id))"
    hex40, hex18, b64 = h, f"substr({h}, 1, 18)", f"substr(translate(base64(unhex(concat({h}, {h}))), '=', 'Q'), 1, 36)"
    long_number = f"lpad(cast(abs(xxhash64({h})) % 10000000000000000 as string), 16, '4')"
    uuid = f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), substr({h}, 17, 4), substr({h}, 21, 12))"
    words = "array('" + "','".join(w for w in DICTIONARY if len(w) > 4) + "')"
    pick = lambda k: f"element_at({words}, 1 + cast(pmod(xxhash64(id, {k}), size({words})) as int))"
    named = f"concat({pick(1)}, initcap({pick(2)}), initcap({pick(3)}), id % 100)"
    letters = f"substr(regexp_replace(base64(unhex(concat({h}, sha1({h})))), '[^A-Za-z]', ''), 1, 20)"
    mixed = f"concat(initcap({pick(11)}), element_at(array('-', '&', '!', '#', '$', '.'), 1 + cast(id % 6 as int)), substr({b64}, 1, cast(2 + id % 6 as int)), id % 97)"
    kinds = [  # word, the two words before it, path, label
        (f"concat('password=', {hex18})", "''", "'in'", "'src'", 1), (f"concat('\"', {hex40}, '\"')", "'token'", "'='", "'src'", 1),
        (f"concat('AKIA', upper(substr({b64}, 1, 16)))", "'use'", "'with'", "'src/app'", 1), (f"concat('ghp_', {b64})", "'export'", "'it'", "'conf'", 1),
        (f"concat('api_key:', {b64})", "''", "'the'", "'conf/app'", 1), (b64, "'secret'", "':'", "'deploy'", 1),
        (hex40, "'at'", "'commit'", "'src'", 0), (uuid, "'request'", "'id'", "'log'", 0), (long_number, "'paid'", "'by'", "'src'", 0),
        (named, "'call'", "'of'", "'src/lib'", 0), (f"concat('sha256:', {h}, substr({h}, 1, 24))", "'image'", "'digest'", "'docker'", 0),
        (f"concat('your_', {pick(4)}, '_goes_here_', id % 10)", "'password'", "'='", "'docs/examples'", 0),
        (f"concat('password=', {mixed})", "'with'", "'the'", "'src'", 1), (mixed, "'user'", "'pwd:'", "'conf'", 1), (f"concat('postgres://app:', {mixed}, '@db.host/x')", "'open'", "'it'", "'src'", 1),
        (f"concat('\"', {letters}, '\"')", "'secret'", "'='", "'conf'", 1), (f"concat('api_key=', {letters})", "'set'", "'it'", "'src'", 1), (f"concat('token:', substr({h}, 1, 10))", "'a'", "'b'", "'app'", 1),
        (pick(5), "'the'", "'password:'", "'src'", 0), (f"concat('token:', {pick(6)}, ',')", "'a'", "'b'", "'src'", 0), (f"concat('sk-', {pick(7)})", "'use'", "'the'", "'src'", 0),
        (f"concat('password=$', upper({pick(8)}))", "'with'", "'a'", "'conf'", 0), (f"concat('secret=', {pick(9)}, '.get(', {pick(10)}, ')')", "'a'", "'new'", "'src'", 0), (f"concat('auth=', substr('********', 1, 4 + id % 5))", "'an'", "'old'", "'log'", 0),
        (f"concat('\"', {pick(12)}, '\":\"', substr({h}, 1, 32), '\"')", "'a'", "'new'", "'src'", 0),
    ]
    case = lambda k: f"CASE pmod(id, {len(kinds)}) " + " ".join(f"WHEN {i} THEN {kind[k]}" for i, kind in enumerate(kinds)) + " END"
    return spark.range(rows).selectExpr(
        "id AS key", "id AS row", "0 AS word_at", f"{case(0)} AS word", f"{case(1)} AS before2", f"{case(2)} AS before", "'' AS after", f"{case(3)} AS path", f"cast({case(4)} AS double) AS label"
    )


def fit_forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestClassificationModel:
    rows = VectorAssembler(inputCols=list(NUMBERS), outputCol="features").transform(labelled).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows)


def labelled_findings(found: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """The corpus's settled findings, at most `most` of them by a hash of their place, and the generated ones."""
    own = settled(found).orderBy(F.xxhash64("row", "word_at", "value_at", "word")).limit(most)
    made = described(generated(found.sparkSession))
    return own.select(*NUMBERS, "label").union(made.select(*NUMBERS, "label"))


def judged(docs: DataFrame, labelled: DataFrame | None, id_column: str, text_column: str, path_column: str | None) -> DataFrame:
    """The candidates' values with their probability and verdict."""
    found = written(described(candidates(docs, id_column, text_column, path_column)), "secret-candidates")
    model = fit_forest(labelled if labelled is not None else labelled_findings(found))
    seen = model.transform(VectorAssembler(inputCols=list(NUMBERS), outputCol="features").transform(found))
    seen = seen.withColumn("p", F.round(F.get(vector_to_array("probability"), F.lit(1)), 6))
    return seen.select("key", "row", "word_at", "value_at", "value", "inside", "before", "after", F.col("p").alias("probability"), (F.col("p") >= 0.5).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = "source") -> DataFrame:
    """One row per value of a candidate word: doc_id, word_at, value, before, after, probability, is_secret.

    `labelled` (the columns NUMBERS and label) replaces the findings that the forest learns from. Null and
    empty texts have no candidates; a null path counts as empty; a null id stays null; rows that
    repeat an id are scanned one by one. An empty table gives no rows; other columns are not read.
    """
    found = judged(docs, labelled, id_column, text_column, path_column)
    return found.select(external_key("key").alias("doc_id"), "word_at", "value", "before", "after", "probability", "is_secret")


def literal(column: str) -> Column:
    """A pattern that matches the column's text."""
    return F.regexp_replace(column, "([^A-Za-z0-9])", r"\\$1")


def ahead() -> Column:
    """A pattern for what precedes a short value: its own name, or the beginning of its word and the word before."""
    first = F.when(F.col("before") != "", F.concat(F.lit(r"(?<!\S)"), literal("before"), F.lit(SPACE))).otherwise(F.lit(r"(?<!\S)"))
    return F.concat(F.when(F.col("value_at") < 4, first).otherwise(F.lit("")), literal("inside"))


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = "n_chars", path_column: str | None = "source") -> DataFrame:
    """`docs` with every secret replaced by a mark; a length column follows the text that changed."""
    row, values, before = unused(docs, "row"), unused(docs, "values"), unused(docs, "before")
    secrets = judged(docs, None, id_column, text_column, path_column).filter("is_secret").groupBy(F.col("row").alias(row))
    # A long value goes wherever the text has it, first the longest; before them the others, each where it was found.
    at = F.when(F.length("value") < LEAST, F.concat(F.lit("("), ahead(), F.lit(")"), literal("value")))
    value = F.struct(at.isNotNull().alias("short"), F.length("value").alias("n"), F.col("value").alias("v"), at.alias("at"))
    in_turn = F.sort_array(F.collect_set(value), asc=False)
    joined = docs.join(secrets.agg(in_turn.alias(values)), row_print(id_column, text_column) == F.col(row), "left")
    put = lambda text, s: F.when(s["short"], F.regexp_replace(text, s["at"], F.lit(f"$1{MARK}"))).otherwise(F.replace(text, s["v"], F.lit(MARK)))
    clean = F.aggregate(F.filter(F.coalesce(values, F.array()), lambda s: s["v"] != ""), F.col(before), put)
    out = joined.withColumn(before, F.col(quoted(text_column))).withColumn(text_column, clean)
    if length_column in docs.columns:
        changed = F.col(before) != F.col(quoted(text_column))
        kind = docs.schema[length_column].dataType
        out = out.withColumn(length_column, F.when(changed, F.length(F.col(quoted(text_column))).cast(kind)).otherwise(F.col(quoted(length_column))))
    return out.select(*[quoted(c) for c in docs.columns])
