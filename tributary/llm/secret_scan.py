"""Secrets in text: patterns propose candidates, a random forest removes false positives.

The forest looks at the length of a candidate, the changes between its kinds of characters, how much
of it a dictionary covers, whether it stands in a path, and the words before and after it. The dictionary
has the frequent words of the corpus; a candidate is cut into the longest of them from left to right. It is trained from
labelled findings and then written out as conditional expressions, so that texts are scanned row by
row with built-in functions, without a join.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrays import GAP, settled, with_matches, words_of
from tributary.llm.tables import Stage

#: A value given to a name that speaks of secrets, or a long run of the characters of keys.
_NAMES = r"(?i:passwords?|passwd|pwd|secrets?|tokens?|api[_-]?keys?|access[_-]?keys?|auth[_-]?keys?|private[_-]?keys?|credentials?)"
CANDIDATE = (
    rf"(?<![A-Za-z]){_NAMES}[\"']?[\x20\t]{{0,3}}[:=][\x20\t]{{0,3}}[\"']?[^\x20\x09-\x0D\"']{{6,}}+"
    r"|(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
)
# The signs at the end of a base64 value are no name's.
_VALUE = rf"(?:^(?:{_NAMES}[\"']?[\x20\t]*[:=]|.*?[:=](?!=*$))[\x20\t]{{0,3}}[\"']?)?([^\x20\x09-\x0D\"']+)$"
_ASSIGNED = rf"^{_NAMES}[\"']?[\x20\t]*[:=]"
#: Words before and after a candidate that speak for and against a secret, characters looked at.
_FOR = r"(?i)(password|passwd|pwd|secret|token|api.?key|access.?key|auth|credential|private)"
_AGAINST = r"(?i)(commit|sha[0-9]*|md5|hash|digest|checksum|uuid|guid|revision|etag|build|order|invoice|page|card|phone)"
NEARBY = 40
#: Words that make up placeholders and identifiers; the dictionary, with frequent words of the corpus.
WORDS = (
    "change", "changeme", "default", "dummy", "example", "guest", "hello", "here", "insert", "name", "none", "null", "password",
    "placeholder", "please", "sample", "secret", "service", "string", "test", "token", "user", "value", "welcome", "your",
)
#: Frequent words taken at most, occurrences that they have at least.
FREQUENT, OCCURRENCES = 2_000, 5
FEATURES = ("length", "changes", "digits", "upper", "distinct", "covered", "path", "assigned", "nearby_for", "nearby_against", "after_for", "after_against", "key_prefix")
#: Documents that labelled findings are derived from, trees and depth of the forest, its threshold.
SAMPLE, TREES, DEPTH, SEED, THRESHOLD = 1500, 15, 5, 17, 0.5
MASK = "[SECRET]"


def frequent_words(docs: DataFrame, text_col: str = "text", most: int | None = FREQUENT) -> list[str]:
    """The words of 4 to 20 letters that occur most often, in lower case: at most ``most``, each at least
    ``OCCURRENCES`` times, ties by the word. Counted over all documents; only these words come to the driver.
    Without a limit (None) all such words do, and make up the pattern that candidates are cut by."""
    text = F.lower(F.col(f"`{text_col}`").cast("string"))
    tokens = docs.select(F.explode(F.split(text, GAP, -1)).alias("w")).where(F.length("w").between(4, 40)).groupBy("w").count()
    # Patterns only meet distinct tokens.
    word = F.regexp_extract("w", r"^[^\p{L}\p{N}]*+(\p{L}{4,20})[^\p{L}\p{N}]*$", 1)
    counted = tokens.select(word.alias("word"), "count").groupBy("word").agg(F.sum("count").alias("n"))
    top = counted.where(f"word <> '' and n >= {OCCURRENCES}").orderBy(F.desc("n"), "word")
    top = top if most is None else top.limit(most)
    return [r.word for r in top.collect()]


def _longest_of(words: list[str]) -> str:
    """A pattern for the longest of the words that begins at a place, common beginnings once."""
    tree: dict = {}
    for word in words:
        at = tree
        for c in word:
            at = at.setdefault(c, {})
        at[""] = {}

    def pattern(at: dict) -> str:
        ways = "|".join(re.escape(c) + pattern(x) for c, x in sorted(at.items()) if c)
        return ways and (f"(?:{ways})?" if "" in at else f"(?:{ways})")

    return pattern(tree)


def _candidates(docs: DataFrame, text: str, dictionary: list[str]) -> DataFrame:
    """Adds ``candidates``: array of (start, stop, value and the features) of the values found."""
    # Every candidate has a digit or is the value of a name.
    gate = F.col(text).rlike(r"[A-Za-z0-9+/_=-]{16}") | F.col(text).rlike(rf"{_NAMES}[\"']?[\x20\t]{{0,3}}[:=]")
    df = with_matches(docs, "found", text, gate, CANDIDATE)

    def described(x: Column) -> Column:
        value = F.regexp_extract(x["match"], _VALUE, 1)
        start = x["start"] + F.length(x["match"]) - F.length(value)
        return F.struct(x["start"].alias("at"), start.alias("start"), (start + F.length(value)).alias("stop"), value.alias("value"), x["match"].alias("match"))

    df = df.withColumn("found", F.transform("found", described))
    known_words = _longest_of([w for w in dictionary if w])
    df = df.withColumn("found", F.filter("found", lambda x: (F.length(x["value"]) >= 6) & (x["value"].rlike("[0-9]") | x["match"].rlike(_ASSIGNED))))

    def features(x: Column) -> Column:
        v, n = x["value"], F.length(x["value"])
        before = F.substring(F.col(text), F.greatest(F.lit(1), x["at"] + 1 - NEARBY), F.least(F.lit(NEARBY), x["at"]))
        after = F.substring(F.col(text), x["stop"] + 1, F.lit(NEARBY))
        low = F.lower(v)
        known = F.length(low) - F.length(F.regexp_replace(low, known_words, "")) if known_words else F.lit(0)
        changes = n - F.length(F.regexp_replace(v, r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])", "")) + F.size(
            F.split(v, r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])", -1)
        )
        numbers = {
            "length": n, "changes": changes / n, "digits": F.length(F.regexp_replace(v, "[^0-9]", "")) / n,
            "upper": F.length(F.regexp_replace(v, "[^A-Z]", "")) / n, "distinct": F.size(F.array_distinct(F.split(v, ""))) / n, "covered": known / n,
            "path": (before.rlike(r"[/\\@.]$") | v.rlike("/.*/|://|@")).cast("int"), "assigned": x["match"].rlike(_ASSIGNED).cast("int"),
            "nearby_for": before.rlike(_FOR).cast("int"), "nearby_against": before.rlike(_AGAINST).cast("int"),
            "after_for": after.rlike(_FOR).cast("int"), "after_against": after.rlike(_AGAINST).cast("int"),
            "key_prefix": v.rlike("^(AKIA|ASIA|ghp_|gho_|xox[bp]-|sk_|rk_|AIza|glpat-)").cast("int"),
        }
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), v.alias("value"), *[c.cast("double").alias(k) for k, c in numbers.items()])

    return df.withColumn("candidates", F.transform("found", features)).drop("found")


def labelled_findings(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(text, label) derived from at most ``sample`` documents, those with the smallest digests: secrets and
    look-alikes, made of digests and words of the documents, each between the words round a place anywhere in a document."""
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).withColumn("o", F.sha2("t", 256))
    # Digests are ordered, not texts; equal texts are one.
    least = Stage(docs.sparkSession).table(texts.select("o").distinct().orderBy("o").limit(sample), "picked")
    picked = texts.join(F.broadcast(least), "o").groupBy("o").agg(F.first("t").alias("t"))
    base = picked.select("o", words_of(F.col("t")).alias("w")).withColumn("n", F.size("w")).where("n >= 4")
    hex_ = F.sha2(F.concat("o", F.lit("hex")), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat("o", F.lit("b64")), 256))), "=+$", "")
    caps = F.upper(F.translate(F.substring(F.sha2(F.concat("o", F.lit("caps")), 256), 1, 16), "0189", "WXYZ"))
    plain = F.regexp_replace(F.lower(F.concat(F.element_at("w", 1), F.element_at("w", 2), F.element_at("w", 3))), "[^a-z]", "")
    digits = F.regexp_replace(F.sha2(F.concat("o", F.lit("num")), 256), "[^0-9]", "")
    # 16 bytes, with the two signs at the end.
    padded = F.base64(F.unhex(F.substring(F.sha2(F.concat("o", F.lit("padded")), 256), 1, 32)))
    quote = F.lit('"')
    secrets = [
        F.concat(F.lit("AKIA"), caps), F.concat(F.lit("password="), F.substring(hex_, 1, 18)), F.concat(F.lit("token = "), quote, F.substring(hex_, 1, 40), quote),
        F.concat(F.lit("api_key: "), quote, b64, quote), F.concat(F.lit("secret="), F.substring(b64, 1, 24)), F.concat(F.lit("ghp_"), F.substring(b64, 1, 36)),
        padded, F.concat(F.lit("Authorization: Basic "), padded),
        F.concat(F.substring(hex_, 1, 32), F.lit(" is the token")),
    ]
    likes = [
        F.concat(F.lit("commit "), F.substring(hex_, 1, 40)), F.concat(F.lit("sha256 "), hex_), F.concat(F.lit("password="), plain), F.concat(F.lit("token: your-token-here-"), F.substring(digits, 1, 2)),
        F.concat(F.lit("https://example.com/page/"), F.substring(hex_, 1, 24)), F.substring(digits, 1, 16), F.concat(plain, F.lit("-"), plain, F.lit("-"), F.substring(digits, 1, 2)),
        F.concat_ws("-", F.lit("uuid"), F.substring(hex_, 1, 8), F.substring(hex_, 9, 4), F.substring(hex_, 13, 4), F.substring(hex_, 17, 12)),
        F.concat(F.lit("md5 "), padded), F.concat(padded, F.lit(" is the checksum")), F.concat(F.substring(hex_, 1, 32), F.lit(" is the digest")),
        F.concat(plain, F.lit("_"), F.substring(digits, 1, 8)),
    ]
    kinds = [F.struct(c.alias("x"), F.lit(label).alias("label")) for label, group in ((1, secrets), (0, likes)) for c in group]
    rows = base.select("w", "o", F.posexplode(F.array(*kinds)).alias("kind", "y"))
    middle = F.expr("int(1 + pmod(xxhash64(o, kind), greatest(size(w) - 1, 1)))")
    # More than ``NEARBY`` characters to either side are never looked at.
    first = F.greatest(F.lit(1), middle - (NEARBY // 2 - 1))
    text = F.concat_ws(" ", F.slice("w", first, middle - first + 1), F.col("y.x"), F.slice("w", middle + 1, F.lit(NEARBY // 2)))
    return rows.select(text.alias("text"), F.col("y.label").alias("label"))


def train(findings: DataFrame, dictionary: list[str] | None = None) -> tuple[RandomForestClassificationModel | None, list[str]]:
    """A forest from labelled findings (text, label), label 0 or 1, a bounded table. None without two labels."""
    dictionary = sorted(set(WORDS) | set(dictionary or []))
    stage = Stage(findings.sparkSession)
    rows = _candidates(findings.where("label in (0, 1) and text is not null"), "text", dictionary)
    rows = rows.select("label", F.explode_outer("candidates").alias("c")).where("c is not null").select(F.col("label").cast("double").alias("label"), *[F.col(f"c.{f}").alias(f) for f in FEATURES])
    # One sorted partition, so that training is the same wherever it runs; the table is small by contract.
    rows = stage.table(rows.repartition(1).sortWithinPartitions("label", *FEATURES), "findings")
    if rows.select("label").distinct().count() < 2:
        return None, dictionary
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(table), dictionary


def _score(model: RandomForestClassificationModel, x: Column) -> Column:
    """The forest's mean probability as nested conditionals over the feature fields of ``x``."""

    def tree(node) -> Column:
        if node.numDescendants() == 0:
            p = node.impurityStats().stats()
            return F.lit(float(p[1] / max(sum(p), 1e-12)))
        split = node.split()
        return F.when(x[FEATURES[split.featureIndex()]] <= F.lit(float(split.threshold())), tree(node.leftChild())).otherwise(tree(node.rightChild()))

    total = F.lit(0.0)
    for t in model.trees:
        total = total + tree(t._java_obj.rootNode())
    return total / len(model.trees)


def find_secrets(docs: DataFrame, model: tuple[RandomForestClassificationModel | None, list[str]], text_col: str = "text") -> DataFrame:
    """The rows with ``secret_candidates``: array of (start, stop, value, score, secret), in order of place.

    Places count code points, ends are exclusive. Null and empty texts have none. Without a trained
    forest all candidates count as secrets. Equal rows get equal findings; ids play no part.
    """
    forest, dictionary = model
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    df = docs.select(row, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    df = _candidates(df, "t", dictionary)

    def judged(x: Column) -> Column:
        score = F.lit(1.0) if forest is None else F.round(_score(forest, x), 6)
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), score.alias("score"))

    scored = df.withColumn("s", F.transform("candidates", judged))
    flagged = F.transform("s", lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), x["score"].alias("score"), (x["score"] >= THRESHOLD).alias("secret")))
    return settled(scored.select("row.*", flagged.alias("secret_candidates")))


def mask_secrets(docs: DataFrame, model: tuple[RandomForestClassificationModel | None, list[str]], text_col: str = "text") -> DataFrame:
    """The rows with the same columns, each secret in the text replaced by ``[SECRET]``."""
    df = find_secrets(docs, model, text_col)
    # Its own column, so that it is made once for each row.
    df = df.withColumn("secret_candidates", F.expr("filter(secret_candidates, x -> x.secret)"))
    text, found = f"`{text_col}`", "secret_candidates"
    stop = f"coalesce(get({found}, i - 1).stop, 0)"
    pieces = f"transform({found}, (x, i) -> concat(substring({text}, {stop} + 1, x.start - {stop}), '{MASK}'))"
    tail = f"substring({text}, coalesce(get({found}, size({found}) - 1).stop, 0) + 1)"
    masked = F.expr(f"case when {text} is null or size({found}) = 0 then {text} else concat(array_join({pieces}, ''), {tail}) end")
    return df.withColumn(text_col, masked).select(*[f"`{c}`" for c in docs.columns])
