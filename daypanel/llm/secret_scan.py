"""Secret scan: candidates by pattern, false positives removed by a random forest. SQL functions and Spark ML only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a word that may be secrets: runs of key characters, keys by the prefix of their issuer, values after a key word whatever marks they hold, passwords of connection strings.
RUN = r"[A-Za-z0-9+/_\-]{12,}={0,2}"
PREFIXED = r"(?:AKIA|ASIA)[A-Z2-7]{16}|(?:gh[pos]_|github_pat_|glpat-|xox[abprs]-|[sr]k_live_|AIza|ya29\.|eyJ|npm_|pypi-|dop_v1_|SG\.)[A-Za-z0-9+/_.\-]{8,}={0,2}"
_NAMED = r"(?i)(?<=(?:pass|word|wd|phrase|secret|token|key|auth|bearer|credential)[A-Za-z0-9_\-]{0,8}[\"']?[=:]{1,2}"
QUOTED_VALUE = _NAMED + r"[\"'])[^\s\"']{12,}(?=[\"'])"
VALUE = _NAMED + r")[^\s\"'&,;:/?@{}\[\]][^\s\"'&,;{}]{10,}[^\s\"'&,;:.)}\]{]"
LOGIN = r"(?<=://[^\s:/@]{0,40}:)[^\s@\"']{8,}(?=@)"
#: A value that stands by itself in a word, after a word that ends a key word and a sign.
ALONE = r"(?<=^[\"']?)[^\s\"'][^\s\"']{10,}[^\s\"'.,;:)}\]]"
AFTER_NAME = r"(?i)(pass|word|wd|phrase|secret|token|key|auth|bearer|credential)[A-Za-z0-9_\-]{0,8}[\"']?\s?[=:]{1,2}$"
#: Characters of the word itself that count as before and after a candidate.
BESIDE = 80
#: The run at the end of a word: the body of a labelled finding.
CORE = r"([A-Za-z0-9+/_\-]{12,}={0,2})[^A-Za-z0-9]*$"
MIXED = r"[0-9]|(AKIA|ASIA)[A-Z2-7]{16}|[a-z][A-Z].*[a-z][A-Z].*[A-Z]"
#: A key word and a value in one word, or a login: such a word holds candidates whatever its characters.
NAMED = r"(?i)(pass|word|wd|phrase|secret|token|key|auth|bearer|credential)[A-Za-z0-9_\-]{0,8}[\"']?[=:]{1,2}[\"']?[^\s\"']|://[^\s:/@]{0,40}:[^\s@\"']{8,}@"
#: Fixed vocabulary of the features.
KEY_WORDS = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key|client[_-]?secret|signing[_-]?key)"
INNOCENT_WORDS = r"(?i)(commit|sha(1|256|512)?|md5|etag|checksum|digest|uuid|guid|revision|version|build|order|invoice|phone|card|isbn|file|image|page|session|trace|span|request)"
PLACEHOLDERS = r"(?i)(example|sample|changeme|change-me|placeholder|your[_-]|dummy|test|xxxx|0000|1234|abcd|todo|redacted|foobar)"
DICTIONARY = (
    r"(?i)(about|account|access|admin|after|and|application|article|author|back|base|birth|block|build|category|center|change|chapter|class|client|cloud|code|comment|common|config|content|control|count|country"
    r"|create|data|date|default|delete|details|device|document|download|edit|email|error|event|example|field|file|first|folder|font|form|from|function|group|have|header|height|history|home|image|index|info|input"
    r"|insert|item|java|label|language|last|layout|left|level|library|like|line|link|list|local|login|mail|main|make|manager|menu|message|method|model|module|month|name|navigation|network|news|next|node|number"
    r"|object|option|order|other|page|panel|parent|part|password|path|payment|people|photo|place|player|point|post|price|print|product|profile|project|public|question|read|record|release|report|request|result"
    r"|return|review|right|role|root|sample|save|screen|script|search|section|select|server|service|session|setting|shop|show|site|size|source|start|state|status|store|string|style|submit|support|system|table|team"
    r"|template|test|text|that|theme|this|time|title|token|total|type|update|upload|user|value|version|video|view|visit|wave|week|width|window|with|word|work|world|year|your|ation|ment|ness|ing|the|ent|ion)"
)
RISKY_PATH = r"(?i)(\.env|\.pem|\.key|config|settings|secret|credential|deploy|prod)"
SAFE_PATH = r"(?i)(test|spec|example|fixture|docs?/|sample|mock)"
FEATURES = (
    "length", "transitions", "distinct_share", "digit_share", "upper_share", "lower_share", "symbol_share", "hex_only", "digits_only", "vowel_pairs", "longest_letters",
    "dictionary", "placeholder", "known_prefix", "assigned", "quoted", "key_before", "innocent_before", "key_after", "innocent_after", "risky_path", "safe_path",
)
#: Beginnings that issuers of keys document.
KNOWN_PREFIX = r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|AIza|ya29|eyJ|npm_|pypi-|dop_v1_|SG)"
TREES, DEPTH, SEED = 40, 10, 5


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, whatever the number of its uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(w: Column, pattern: str, rank: int) -> Column:
    """The matches of a pattern in a word, with their rank and place and with what stands before and after each, ``BESIDE`` characters at most."""

    def rows(x: Column) -> Column:
        found, between = x["found"], x["between"]

        def row(core: Column, k: Column) -> Column:
            lead = F.right(F.concat(F.coalesce(F.get(found, k - 1), F.lit("")), F.get(between, k)), F.lit(BESIDE))
            tail = F.left(F.concat(F.get(between, k + 1), F.coalesce(F.get(found, k + 1), F.lit(""))), F.lit(BESIDE))
            return F.struct(core.alias("core"), F.lit(rank).alias("rank"), k.alias("k"), lead.alias("lead"), tail.alias("tail"))

        return F.transform(found, row)

    return _bound(F.struct(F.regexp_extract_all(w, F.lit(pattern), F.lit(0)).alias("found"), F.split(w, pattern, -1).alias("between")), rows)


def _once(matches: Column) -> Column:
    """All matches of rank 0, and of the others each text once and only where no rank 0 has it: sorted by text, a repeat follows its equal."""
    return _bound(F.array_sort(matches), lambda rows: F.filter(rows, lambda m, k: (m["rank"] == 0) | (k == 0) | (m["core"] != F.get(rows, k - 1)["core"])))


def candidates(docs: DataFrame, path: str) -> DataFrame:
    """One row per candidate: ``doc_id``, ``word_no``, ``core``, ``word`` (the core and what stands beside it in its word), ``before``, ``after``, ``path``."""
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    rows = docs.select("doc_id", F.col(path).cast("string").alias("path"), words.alias("words"))

    def at(k: Column) -> Column:
        return F.coalesce(F.get("words", k), F.lit(""))

    def row(w: Column, i: Column) -> Column:
        before = F.concat_ws(" ", at(i - 3), at(i - 2), at(i - 1))
        likely = (F.length(w) >= 12) & (w.rlike(MIXED) | w.rlike(NAMED) | before.rlike(AFTER_NAME))
        return F.when(likely, F.struct(i.alias("word_no"), w.alias("word"), before.alias("before"), F.concat_ws(" ", at(i + 1), at(i + 2)).alias("after")))

    found = rows.select("doc_id", "path", F.explode(F.filter(F.transform("words", row), lambda x: x.isNotNull())).alias("x"))
    w = F.col("x.word")
    every = [_matches(w, p, k) for k, p in enumerate((RUN, PREFIXED, QUOTED_VALUE, VALUE, LOGIN))]
    alone = F.when(F.col("x.before").rlike(AFTER_NAME), _matches(w, ALONE, len(every))).otherwise(F.expr("array()"))
    found = found.select("doc_id", "path", "x.word_no", "x.before", "x.after", F.explode(_once(F.concat(*every, alone))).alias("y"))
    word, after = F.concat("y.lead", "y.core", "y.tail"), F.concat_ws(" ", "y.tail", "after")
    return found.select("doc_id", "word_no", "y.core", word.alias("word"), "before", after.alias("after"), "path")


def with_features(rows: DataFrame) -> DataFrame:
    """Adds the columns of ``FEATURES``, doubles."""
    core, n = F.col("core"), F.length("core")
    count = lambda pattern: F.regexp_count(core, F.lit(pattern))
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    lead = F.expr("substring_index(word, core, 1)")  # what stands in the word before its core
    context = F.concat_ws(" ", "before", lead)
    kinds = {
        "length": n, "transitions": count(r"[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])") / n,
        "distinct_share": F.size(F.array_distinct(F.split(core, ""))) / F.least(n, F.lit(32)), "digit_share": count("[0-9]") / n, "upper_share": count("[A-Z]") / n, "lower_share": count("[a-z]") / n,
        "symbol_share": count("[^A-Za-z0-9]") / n, "hex_only": flag(core.rlike("^([0-9a-f]+|[0-9A-F]+)$")), "digits_only": flag(core.rlike("^[0-9_-]+$")),
        "vowel_pairs": count(r"(?i)[bcdfghjklmnprstvwyz](?=[aeiou])") / n,
        "longest_letters": F.array_max(F.concat(F.array(F.lit(0)), F.transform(F.regexp_extract_all(core, F.lit("([a-z]+|[A-Z][a-z]+)"), F.lit(1)), F.length))) / n,
        "dictionary": (n - F.length(F.regexp_replace(core, DICTIONARY, ""))) / n, "placeholder": flag(core.rlike(PLACEHOLDERS)), "known_prefix": flag(core.rlike(KNOWN_PREFIX)),
        "assigned": flag(context.rlike(r"[=:]\s*[\"']?$")), "quoted": flag(F.col("word").rlike(r"[\"'].*[\"']")), "key_before": flag(context.rlike(KEY_WORDS)), "innocent_before": flag(context.rlike(INNOCENT_WORDS)),
        "key_after": flag(F.col("after").rlike(KEY_WORDS)), "innocent_after": flag(F.col("after").rlike(INNOCENT_WORDS)), "risky_path": flag(F.col("path").rlike(RISKY_PATH)), "safe_path": flag(F.col("path").rlike(SAFE_PATH)),
    }
    return rows.withColumns({name: value.cast("double") for name, value in kinds.items()})


#: Recipes of the labelled findings, fixed values: body, word around it (% is the body), words before, words after, path, label.
#: Bodies: hexN, HEXN, base64N, base32N, digitsN, or the text itself.
RECIPES = (
    ("hex40", '"%"', "then token =", "for the", "", 1), ("hex18", "password=%", "and the", "was set", "", 1), ("hex20", "password=%", "user and", "", "app/config.yml", 1), ("base64_40", "%", "aws secret access key", "end", "", 1),
    ("AKIA+base32_16", "%", "of the text", "and so", "", 1), ("AKIA+base32_16", "%", "access key id", "", "deploy/prod.env", 1), ("ghp_+base64_36", "%", "remote with", "for push", "", 1), ("hex32", "api_key=%", "call with", "", "", 1),
    ("hex40", "token:%", "", "", "src/settings.py", 1), ("base64_32", '"%"', "client_secret =", "in the", "", 1), ("base64_24", "secret=%", "", "", "", 1), ("sk_live_+base64_24", "%", "charge by", "", "", 1),
    ("hex64", "%", "private key is", "keep it", "", 1), ("base64_43", "'%'", "bearer auth token", "", "", 1), ("base64_20", "pwd:%", "login with", "", "", 1), ("xoxb-+base64_30", "%", "bot uses", "", "", 1),
    ("hex40", '"%"', "the token =", "was", "unit/test/a.py", 1), ("AIza+base64_35", "%", "map loads", "", "", 1),
    ("digits16", "%", "of the text", "and so", "", 0), ("digits14", "%", "order number", "was sent", "", 0), ("digits12", "%", "call phone", "now", "", 0), ("digits16", "%", "card", "expires", "", 0), ("hex40", "%", "fixed in commit", "by me", "", 0),
    ("hex64", "%", "file sha256 checksum", "ok", "", 0), ("hex32", "etag=%", "header", "", "", 0), ("uuid", "%", "with uuid", "in the", "", 0), ("uuid", "request:%", "trace", "", "", 0), ("changeme12345678", "password=%", "use", "", "", 0),
    ("your-token-here-0000", "token=%", "set", "", "docs/readme", 0), ("XXXXXXXXXXXX1234", "key=%", "paste", "", "", 0), ("example-api-key-123", "api_key=%", "", "", "", 0), ("image_file_20230112", "%", "see", "for", "", 0),
    ("release-version-2024-05", "%", "in the", "of", "", 0), ("getUserAccountDetailsByName", "%", "call", "with", "", 0), ("articlePageNavigationTest2", "%", "in", "", "", 0), ("user_session_data_v2", "%", "table", "has", "", 0),
    ("mail8+digits9", "%", "write to", "", "", 0), ("document-template-2021", "%", "the", "and", "", 0), ("digits13", "isbn:%", "book", "", "", 0), ("digits10-digits8", "%", "from", "to", "", 0), ("hex40", "%", "build revision", "done", "", 0),
)
PER_RECIPE = 60


def findings(spark: SparkSession) -> DataFrame:
    """The labelled findings: ``PER_RECIPE`` rows per recipe, bodies drawn from digests of a running number."""
    recipes = spark.createDataFrame([(k, *r) for k, r in enumerate(RECIPES)], "recipe int, body string, around string, before string, after string, path string, label int")
    digest = F.concat(*(F.sha2(F.concat_ws("/", "recipe", "no", F.lit(k)), 256) for k in range(2)))
    rows = recipes.withColumn("no", F.explode(F.sequence(F.lit(1), F.lit(PER_RECIPE)))).withColumn("digest", digest)
    raw = F.base64(F.unhex("digest"))
    b64, b32 = F.translate(raw, "+/=", "xY9"), F.translate(F.upper(raw), "+/=0189", "ABCDEFG")
    digits = F.translate("digest", "abcdef", "104978")
    prefix, body = F.regexp_extract("body", r"^(.*)\+", 1), F.regexp_replace("body", r"^.*\+", "")
    size = F.regexp_extract(body, r"(\d+)$", 1).try_cast("int")
    drawn = (
        F.when(body.rlike("^hex"), F.substring("digest", F.lit(1), size)).when(body.rlike("^base64_"), F.substring(b64, F.lit(1), size)).when(body.rlike("^base32_"), F.substring(b32, F.lit(1), size))
        .when(body == "uuid", F.regexp_replace(F.substring("digest", 1, 32), r"^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"))
        .when(body == "digits10-digits8", F.concat_ws("-", F.substring(digits, 1, 10), F.substring(digits, 11, 8))).when(body.rlike("^digits"), F.substring(digits, F.lit(1), size)).otherwise(body)
    )
    rows = rows.withColumn("word", F.replace("around", F.lit("%"), F.concat(prefix, drawn)))
    return rows.select(F.regexp_extract("word", CORE, 1).alias("core"), "word", "before", "after", "path", F.col("label").cast("double").alias("label")).where("core <> ''")


def fit(spark: SparkSession, labelled: DataFrame | None = None) -> RandomForestClassificationModel:
    """The forest, fitted to labelled findings: ``core``, ``word``, ``before``, ``after``, ``path``, ``label``."""
    rows = with_features(findings(spark) if labelled is None else labelled)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("features", "label").coalesce(1)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(rows)


def scan(docs: DataFrame, path: str = "source", threshold: float = 0.5, model: RandomForestClassificationModel | None = None) -> DataFrame:
    """Secrets in whole texts.

    ``docs`` has ``doc_id``, ``text`` and a column that tells where the text is from. Returns one row per candidate: ``doc_id``, ``word_no`` (0 for the
    first piece between white space), ``masked`` (four characters and the length), ``digest`` (a hash, so that one secret can be followed without showing it),
    ``probability`` and ``is_secret``. Candidates lie anywhere in a word that holds a digit, changing case, a key word with its value or a login, or that follows a key word and a sign: every
    run of at least twelve key characters, keys by their issuer's prefix, values of at least twelve characters after a key word and passwords of
    connection strings, whatever marks these hold; they may overlap, and a value that is one run counts once. The forest weighs its length, changes of character class, dictionary cover, placeholders, path and the words beside it.

    Null and empty texts have no candidates; a null path counts as unknown; null ids are kept; repeated rows give their
    findings again; extra columns are ignored. Only SQL functions and the forest's JVM code touch the rows.
    """
    model = model or fit(docs.sparkSession)
    rows = with_features(candidates(docs, path))
    scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
    probability = vector_to_array("probability")[1]
    return scored.select(
        "doc_id", F.col("word_no").cast("long").alias("word_no"), F.concat(F.substring("core", 1, 4), F.lit("*"), F.length("core")).alias("masked"),
        F.xxhash64("core").alias("digest"), F.round(probability, 6).alias("probability"), (probability >= threshold).alias("is_secret"),
    )
