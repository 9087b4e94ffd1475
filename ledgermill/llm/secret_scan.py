"""Secret scanning: a wide regular-expression net, and a random forest that removes false alarms.

The net finds key-like strings, strings with a known key prefix, values assigned to telling names, passwords in
urls and private-key blocks. The forest judges
each finding by its length, character transitions, dictionary coverage, path and neighbouring words. The dictionary
is the corpus': words that stand alone in several documents. The forest
is trained from labelled findings; without any of the user's own, snippets built from the corpus'
words around made-up keys and look-alikes (hashes, ids, paths, placeholders) are labelled by construction.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.frames import cut
from ledgermill.operators.joins import keyed_join

#: Documents whose words surround the made-up findings, and the words taken of each.
CONTEXTS, CONTEXT_WORDS = 400, 8
TREES, DEPTH, SEED = 30, 6, 8
MASK = "[SECRET]"
#: Characters around a finding that its neighbouring words are read from.
BEFORE, AFTER = 48, 16

#: A word is in the dictionary when it stands alone in so many documents.
KNOWN = 3

# Names by their first letter, so that most places in a text are left after one character.
_NAME = (
    "p(?:ass(?:w(?:or)?d|phrase|code)|wd|rivate[_-]?key)|(?<![a-z])pass(?![a-z])|s(?:ecret|igning[_-]?key)|token|"
    "c(?:redential|lient[_-]?key)|bearer|a(?:pi|ccess|uth)[_-]?key|encryption[_-]?key"
)
_BLOCK = "[A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
# Up to the closing line, whatever lines or escaped line breaks are between.
_PEM = f"-----BEGIN {_BLOCK}[^-]*+(?:-(?!----)[^-]*+)*+-----END {_BLOCK}"
# A sign after the name and what belongs to it takes a value of any length; without one the value has 6 characters or more.
_SIGN = "[\\w.-]{0,40}[\"'\\])]{0,2}\\s{0,2}(?:=>|:=|[=:])\\s{0,2}[\"'(]?"
_BLANK = "\\s[\"']?"
_ASSIGNED = f"(?i:{_NAME})(?:{_SIGN}[^\\s\"',;)]++|{_BLANK}[^\\s\"',;]{{6,}}+)"
# What keys of known services begin with.
_PREFIX = "AKIA|ASIA|AIza|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|sk-|rk_live_|xoxa-|xoxb-|xoxp-|eyJ"
_PREFIXED = f"(?=[Agsrxe])(?<![A-Za-z0-9])(?:{_PREFIX})[A-Za-z0-9_./+=-]{{8,}}+"
_IN_URL = "(?<=://)[^\\s/:@\"']{0,64}:[^\\s/@\"']{1,256}+(?=@)"
# A bare key has a digit, or capitals and small letters in a longer run.
_KEY = (
    "(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{16})(?:(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]++"
    "|(?=[a-z+/_-]*+[A-Z])(?=[A-Z+/_-]*+[a-z])[A-Za-z+/_-]{20,}+)={0,2}"
)
PATTERN = f"{_PEM}|{_IN_URL}|{_ASSIGNED}|{_PREFIXED}|{_KEY}"
# What precedes the value in a match: name and sign, or the user of a url.
_VALUE = f"^(?:(?i:{_NAME})(?:{_SIGN}|{_BLANK})|[^\\s/:@\"'=-]{{0,64}}:(?=[^\\s/@]++$))"

# Words that mark placeholders and prose rather than keys.
_PLAIN = (
    "example|sample|test|dummy|change|your|here|none|null|true|false|required|password|token|secret|"
    "user|name|admin|value|field|string|file|path|home|share|local|python|https|http|www|com|org|net|"
    "the|and|for|with|that|this|from|xxx|000|123|abc"
)
FEATURES = (
    "n", "digits", "uppers", "lowers", "others", "switches", "distinct", "plain", "covered", "hexadecimal",
    "known_prefix", "in_path", "dots", "assigned", "named", "hash_near", "quoted",
)


def _runs() -> Column:
    """Runs of letters that the dictionary is asked for; a capital after a small letter begins another run."""
    parted = F.regexp_replace(F.left("value", F.lit(256)), "([a-z])([A-Z])", "$1 $2")
    return F.regexp_extract_all(F.lower(parted), F.lit("[\\p{L}]{3,}"), F.lit(0))


def findings_in(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per match: the columns ``keep``, start (in characters), match, value, before and after."""
    found = docs.withColumn("found", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).filter(
        F.size("found") > 0
    )
    between = found.withColumn("between", F.split("text", PATTERN, -1)).withColumns({
        "found_n": F.transform("found", lambda x: F.length(x)),
        "between_n": F.transform("between", lambda x: F.length(x)),
    })
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    at = F.col("at")
    rows = between.select(*keep, "found_n", "between_n", "between", F.posexplode("found").alias("at", "match"))
    before = F.get("between", at)
    value = F.regexp_replace("match", _VALUE, "")
    return rows.select(
        *keep,
        (
            total(F.slice("between_n", F.lit(1), at + 1)) + total(F.slice("found_n", F.lit(1), at))
            + F.length("match") - F.length(value)
        ).alias("start"),
        "match", value.alias("value"),
        F.when(F.length(before) > BEFORE, F.right(before, F.lit(BEFORE))).otherwise(before).alias("before"),
        F.left(F.get("between", at + 1), F.lit(AFTER)).alias("after"),
    ).filter("value <> ''")


def _share(value: Column, pattern: str) -> Column:
    """Share of the characters that are left when those of a pattern are removed."""
    return F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def with_features(found: DataFrame) -> DataFrame:
    """What the forest looks at, as doubles; ``covered`` comes from :func:`with_coverage`. Of a longer value the first 256
    characters are described, with 256 as its length; the finding itself is the whole value."""
    value = F.left("value", F.lit(256))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")
    has = lambda c, p: c.rlike(p).cast("double")
    named = F.col("match") != F.col("value")
    columns = {
        "n": F.least(F.length("value"), F.lit(256)),
        "digits": _share(value, "[^0-9]"),
        "uppers": _share(value, "[^A-Z]"),
        "lowers": _share(value, "[^a-z]"),
        "others": _share(value, "[A-Za-z0-9]"),
        # Runs of one kind of character, by what is left when repeated kinds are one.
        "switches": F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) / F.length(value),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "plain": 1 - F.length(F.regexp_replace(F.lower(value), _PLAIN, "")) / F.length(value),
        "hexadecimal": has(value, "^[0-9a-f]{12,}$"),
        "known_prefix": has(value, f"^({_PREFIX}|-----BEGIN)"),
        "in_path": F.greatest(has(F.col("before"), r"[/.@\\]$"), has(value, "/[a-z]{2,}/|://|@")),
        "dots": has(F.col("after"), r"^[.@/][A-Za-z]"),
        "assigned": F.greatest(has(F.col("before"), r"[=:]\s{0,2}[\"']?$"), has(F.col("match"), r"^[^\s\"']{1,20}[\"']?\s{0,2}[=:]")),
        "named": F.greatest(named.cast("double"), has(F.col("before"), f"(?i)({_NAME}|key)[\\w]{{0,12}}[\"']?\\s{{0,2}}[=:]?\\s{{0,2}}[\"']?$")),
        "hash_near": has(F.col("before"), r"(?i)\b(sha\d*|md5|commit|checksum|digest|hash|uuid|guid|id|rev|ref|etag)\b[^A-Za-z]{0,4}$"),
        "quoted": has(F.col("after"), "^[\"']"),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in columns.items()})


def dictionary(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(word): what stands alone, as a word of letters, in KNOWN documents or more, of the runs of letters in findings.

    Only words that findings ask for are counted. Copies of a text count as documents of their own.
    """
    asked = found.select(F.explode(_runs()).alias("word")).distinct()
    # What is asked for holds letters only, so nothing with a digit or one of these signs in it counts.
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_/+=-]+"))
    said = docs.select(F.explode(words).alias("word")).join(asked, "word", "left_semi")
    return said.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= KNOWN).select("word")


def with_coverage(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with ``covered``: the share of a value's characters that lie in words of the dictionary.

    Equal values are looked up once. Findings are few beside the documents; only they are shuffled.
    """
    runs = found.select("value").distinct().select("value", F.explode(_runs()).alias("word"))
    covered = runs.join(known, "word").groupBy("value").agg(
        (F.sum(F.length("word")) / F.least(F.first(F.length("value")), F.lit(256))).alias("covered")
    )
    # A value may stand in very many documents.
    joined = keyed_join(found, covered, ["value"], "left", force_salt=True, profile=found.select("value"))
    return joined.withColumn("covered", F.coalesce("covered", F.lit(0.0)))


def made_up_findings(docs: DataFrame) -> DataFrame:
    """Labelled findings (the columns of :func:`findings_in` and ``label``) around words of the corpus.

    At most CONTEXTS documents are used, those with the smallest hash of their text. Rows that cannot be among
    them go before anything is shuffled: with hashes spread evenly, the smallest lie below a few shares of their range.
    """
    words = F.filter(F.split("text", r"\s+"), lambda w: w.rlike(r"^\p{L}{1,12}$"))
    n = max(1, docs.count())
    ticket = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    context = (
        docs.filter("text is not null").withColumn("h", F.xxhash64("text", F.lit(8)))
        .filter(ticket < 3.0 * CONTEXTS / n)
        # Copies of one text count once.
        .groupBy("h").agg(F.min(F.slice(words, 1, CONTEXT_WORDS)).alias("w"))
        .orderBy(ticket, "h").limit(CONTEXTS)
    )
    # An empty corpus still gives a forest.
    blank = docs.sparkSession.range(40).select(
        F.xxhash64("id").alias("h"), F.array().cast("array<string>").alias("w")
    )
    digest = lambda k: F.sha2(F.concat(F.col("h").cast("string"), F.lit(f"/{k}")), 512)
    hexa = lambda k, n: F.substring(digest(k), 1, n)
    upper = lambda k, n: F.translate(hexa(k, n), "0123456789abcdef", "A7K2MZQX4HT5RB3W")
    mixed = lambda k, n: F.substring(
        F.translate(F.base64(F.unhex(digest(k))), "\r\n", ""), 1, n
    )
    alnum = lambda k, n: F.regexp_replace(mixed(k, n), "[+/=]", "k")
    uuid = lambda k: F.concat_ws("-", *[F.substring(digest(k), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    word = lambda k: F.lower(F.coalesce(F.get("w", F.lit(k)), F.lit("word")))
    text = F.concat
    say = F.lit
    secret = [
        text(say("AKIA"), upper(1, 16)), text(say("aws_access_key_id = AKIA"), upper(2, 16)),
        text(say('token = "'), hexa(3, 40), say('"')), text(say("token: "), hexa(4, 32)),
        text(say("password="), hexa(5, 18)), text(say("passwd: "), alnum(6, 12)),
        text(say("api_key='"), mixed(7, 40), say("'")), text(say("secret = "), mixed(8, 44)),
        text(say("Bearer "), alnum(9, 40)), text(say("ghp_"), alnum(10, 36)),
        text(say("sk_live_"), alnum(11, 24)), text(say("password: "), alnum(12, 16), say("!")),
        text(say('"secret": "'), hexa(13, 64), say('"')), text(say("access_key="), upper(14, 20)),
        text(say("-----BEGIN RSA PRIVATE KEY-----\n"), mixed(15, 64), say("\n"), mixed(16, 64), say("\n-----END RSA PRIVATE KEY-----")),
        text(say("token="), alnum(17, 24)), text(say("API-KEY: "), hexa(18, 32)),
        text(say("AKIA"), F.translate(hexa(19, 16), "0123456789abcdef", "QXRTVWMNBKZLPAEI")), text(say("SECRET_KEY='"), mixed(20, 40), say("'")),
        text(say("AUTH_TOKEN_PROD="), alnum(21, 24)), text(say('db_pass = "'), alnum(22, 9), say('"')), text(say("DB_PASS="), alnum(23, 7)),
        text(say("password="), alnum(24, 5)), text(say('"client_secret" : "'), alnum(25, 20), say('"')), text(say("passphrase: "), mixed(26, 14)),
        text(say("postgres://"), word(2), say(":"), alnum(27, 10), say("@db.internal:5432/main")), text(say("mysql://root:"), alnum(28, 6), say("@10.0.0.7/app")),
        text(
            say("-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,"), F.upper(hexa(29, 32)), say("\n\n"),
            mixed(30, 64), say("\n-----END RSA PRIVATE KEY-----"),
        ),
        text(say("-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 2\n\n"), mixed(51, 64), say("\n-----END PGP PRIVATE KEY BLOCK-----")),
        text(say("-----BEGIN PRIVATE KEY-----\\n"), mixed(52, 64), say("\\n-----END PRIVATE KEY-----")),
        text(say("glpat-"), alnum(53, 20)), text(say("eyJ"), alnum(54, 33), say(".eyJ"), alnum(55, 40), say("."), alnum(56, 43)),
        F.regexp_replace(mixed(57, 40), "[0-9]", "x"), text(say("private_key: "), hexa(58, 64)), text(say("pwd="), alnum(59, 8)),
    ]
    harmless = [
        text(say("commit "), hexa(31, 40)), text(say("sha256: "), hexa(32, 64)), text(say("md5="), hexa(33, 32)),
        text(say("id: "), uuid(34)), text(say("see "), hexa(35, 40)), text(say("build "), hexa(36, 20)),
        text(say("/usr/share/lib/python3/"), word(0), say("/x86_64-linux-gnu")),
        text(say("https://www.example.com/"), word(1), say("/20251101/article-"), F.translate(hexa(37, 6), "abcdef", "123456")),
        say("password=changeme"), say("password: your_password"), say('token = "example_token_1234567"'),
        say("api_key=XXXXXXXXXXXXXXXX"), say('secret: "none-required"'), say("token = 0000000000000000"),
        text(say("token "), word(2), word(3), word(4)), text(say("password "), word(3), word(5)),
        text(say("secret: "), word(4), word(5)), text(word(0), word(1), word(2), say("2026edition")),
        text(word(1), say("_"), word(2), say("_"), word(3), say("_v2_final")),
        text(say("mail "), word(2), say(".61"), say("@mail7.example.com")), text(say("checksum "), mixed(38, 44)),
        text(say("uuid="), uuid(39)), text(say("phone 555-0100-2000-30"), hexa(40, 2)),
        text(say("token: "), word(1)), text(say("password: "), word(2)), text(say("secret="), word(3)), text(say("the password is: "), word(0)),
        say("password=${DB_PASSWORD}"), say("token: <your-token>"), say("api_key = os.environ"), say('"password": "********"'), say("pwd: n/a"),
        say("https://user:password@example.com/"), text(say("see http://"), word(0), say(":8080@")), say("token_count: 2048"), say("max_tokens = 512"),
        text(word(0), F.initcap(word(1)), F.initcap(word(2)), F.initcap(word(3)), say("Handler")),
        text(say("passage: "), word(1), say(" "), word(2)), text(say("secretary: "), F.initcap(word(3))), say("password: required"), say("token=null"),
        text(word(1), say("/"), word(2), say("/"), word(3), say("/"), word(4)), text(say("passed: "), word(2)), say("password_length: 12"),
    ]
    label = lambda parts, y: [F.struct(p.alias("said"), say(float(y)).alias("label")) for p in parts]
    snippets = (
        context.unionByName(blank)
        .select("w", F.explode(F.array(*label(secret, 1), *label(harmless, 0))).alias("s"))
        .select(
            F.concat(
                F.array_join(F.slice("w", 1, 4), " "), F.lit(" "), F.col("s.said"), F.lit(" "),
                F.array_join(F.slice("w", 5, 4), " "),
            ).alias("text"),
            F.col("s.label").alias("label"),
        )
    )
    return findings_in(snippets, "label")


def train(labelled: DataFrame) -> PipelineModel:
    """Random forest from labelled findings (match, value, before, after, covered, label 1.0 for secrets)."""
    rows = with_features(labelled.filter("label in (0.0, 1.0)")).select("label", *FEATURES)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="features"),
        RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8),
    ]).fit(cut(rows))


def _scored(docs: DataFrame, key: str, labelled: DataFrame | None, corpus: DataFrame | None = None) -> DataFrame:
    """Findings of ``docs`` (``key`` and text) with ``score``, by a forest and a dictionary made from the whole corpus."""
    found = cut(findings_in(docs, key))
    texts = (docs if corpus is None else corpus).filter("text is not null").select("text")
    learned = cut(labelled if labelled is not None else made_up_findings(texts))
    known = cut(dictionary(texts, found.select("value").unionByName(learned.select("value"))))
    model = train(with_coverage(learned, known))
    return judged(with_coverage(found, known), model)


def judged(found: DataFrame, model: PipelineModel) -> DataFrame:
    """Findings with ``score``, the forest's probability that one is a secret."""
    kept = found.columns
    scored = model.transform(with_features(found))
    return scored.select(*kept, vector_to_array("probability")[1].alias("score"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """One row per secret: doc_id, start and length in characters, kind, value_sha256 and score.

    Null and empty texts have no findings. Repeated rows report their findings as often as they occur; a null
    doc_id is kept; other columns are not read. Texts of any length are scanned whole; findings do not overlap, and of two
    that begin together the kind named first in the net is reported. Values are reported as digests only. ``labelled`` has
    match, value, before, after and label.
    """
    texts = _texts(docs)
    kind = (
        F.when(F.col("value").startswith("-----BEGIN"), "private key")
        .when(F.col("value").rlike("^(AKIA|ASIA)"), "access key id")
        .when(F.col("match") != F.col("value"), F.lower(F.regexp_extract("match", f"^(?i:{_NAME})", 0)))
        .otherwise("key")
    )
    return _scored(texts, "doc_id", labelled).filter(F.col("score") >= least).select(
        "doc_id", F.col("start").cast("long").alias("start"), F.length("value").cast("long").alias("length"),
        kind.alias("kind"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score",
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """The documents with every secret replaced by ``MASK``; ``n_chars`` follows if there is one.

    All rows and columns stay. Documents without any finding are passed on as they are, without a shuffle.
    """
    # Written once, so that the row numbers hold when a task is run again.
    row, secrets = f"_row_{uuid.uuid4().hex}", f"_secrets_{uuid.uuid4().hex}"
    suspect = F.coalesce(F.size(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))) > 0, F.lit(False))
    doubtful = cut(docs.filter(suspect).withColumn(row, F.monotonically_increasing_id()))
    found = _scored(doubtful.select(row, "text"), row, labelled, docs).filter(F.col("score") >= least)
    # Longer ones first, so that none is cut by one that it contains.
    longest = F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False)
    values = found.groupBy(row).agg(longest.alias(secrets))
    clean = F.aggregate(
        secrets, F.col("text"), lambda text, s: F.replace(text, s["value"], F.lit(MASK))
    )
    masked = doubtful.join(values, row, "left").withColumn(
        "text", F.when(F.col(secrets).isNotNull(), clean).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn(
            "n_chars",
            F.when(F.col(secrets).isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")),
        )
    return docs.filter(~suspect).unionByName(masked.select(docs.columns))
