"""Secret scan with a random forest that removes false positives, in DataFrame functions alone.

Candidates are strings with a digit, of a provider's form or of letters in mixed case, whatever
a secret's name assigns, and PEM private keys. Their features are length, kinds of characters and
changes between them, the share of letter triples that the corpus's common words have
(dictionary coverage), the document's path, and the words around. A random forest,
trained on labelled findings, tells secrets from addresses, numbers and other look-alikes.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.session import settle
from .common import lower_ascii

# Words that name a secret, and the forms of keys that name their provider.
NAMES = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|auth|credential|private.?key)"
ASSIGNED = r"[A-Za-z0-9_.-]{0,64}?(?i:token|secret|passw|pwd|api.?key|access.?key|auth|credential|private.?key)[A-Za-z0-9_.-]{0,64}+[\"']?[ \t]{0,8}+(?:=>|:=|[=:])[ \t]{0,8}+"
"""A name of a secret and what assigns it, up to the quote before the value."""
PROVIDERS = {
    "aws-access-key": r"^AKIA[0-9A-Z]{16}$",
    "github-token": r"^gh[pousr]_[A-Za-z0-9]{36,}$",
    "google-api-key": r"^AIza[0-9A-Za-z_-]{35}$",
    "slack-token": r"^xox[abprs]-[0-9A-Za-z-]{10,}$",
    "stripe-key": r"^[sr]k_live_[0-9A-Za-z]{16,}$",
    "private-key": r"^-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY",
}
# Forms of what is no secret.
HARMLESS = r"^[0-9.+-]+$|@|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}|^[A-Za-z]+[.]?[0-9]{1,4}$|^(www|https?)[.:]"
PEM = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:[^-]*+(?:-{1,4}+[^-]++){0,64}+-----END [A-Z0-9 ]{0,40}-----|(?:\s*+[A-Za-z0-9+/=]{16,}+){0,500}+)"
NAMED = ASSIGNED + r"(?:\"(?!-----BEGIN )[^\s\"]++\"?+|'(?!-----BEGIN )[^\s']++'?+|(?![\"']|-----BEGIN )[^\s]++)"
FORMS = r"AKIA[0-9A-Z]{16}\b|gh[pousr]_[A-Za-z0-9]{36,}+|AIza[0-9A-Za-z_-]{35}|xox[abprs]-[0-9A-Za-z-]{10,}+|[sr]k_live_[0-9A-Za-z]{16,}+"
LETTERS = r"(?=[A-Z_+/-]*+[a-z_+/-]++[A-Z])[A-Za-z_+/-]{16,}+=*+"
CANDIDATE = PEM + r"|(?<![A-Za-z0-9_+/.@=-])(?:" + NAMED + "|" + FORMS + r"|[A-Za-z_+/.@=-]*+[0-9][A-Za-z0-9_+/.@=-]*+|" + LETTERS + ")"
LEAST = 8
"""Characters of a candidate that no secret's name assigns, at least."""
BEFORE, AFTER = 32, 16
"""Characters of the text around a candidate."""
DICTIONARY_SHARE = 16_384
"""A dictionary word is 1/16384 of all words or more, so there are at most 16384."""
SAMPLE = 10_000
"""Labelled values of each label that the forest is trained on, about so many at most, drawn by hash and weighted by their share."""
TREES, DEPTH, SEED = 20, 6, 5
DECISION = 0.5
FEATURES = ["length", "digits", "uppers", "lowers", "marks", "changes", "variety", "coverage", "hexadecimal", "path_depth", "path_example", "named", "named_near", "assigned", "quoted"]


def dictionary_triples(docs: DataFrame, text: str, share: int = DICTIONARY_SHARE) -> DataFrame:
    """The letter triples (triple) of all words that make up 1/``share`` of the words of the corpus or more."""
    words = docs.select(F.explode(F.split(lower_ascii(F.col(text)), r"[^a-z\x{80}-\x{10FFFF}]+")).alias("word")).filter("word <> ''")
    counts = settle(words.groupBy("word").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.filter((F.col("n") * share >= total) & (F.length("word") >= 3) & (F.length("word") <= 64))
    return settle(common.select(F.explode(_triples(F.col("word"))).alias("triple")).distinct())


def _triples(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - 2), lambda i: F.substring(word, i, F.lit(3)))


def find_candidates(docs: DataFrame, doc_id: str, text: str, path: str) -> DataFrame:
    """doc_id, path, start (0-based, in characters), value, name, before, after of every place of a candidate.

    A text is cut at its candidates; places are running lengths of the pieces, so the
    cost grows with the text alone.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    wholes, gaps = F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)), F.split(body, CANDIDATE, -1)
    ends = F.transform(gaps, lambda g: F.struct(F.length(g).alias("size"), F.left(g, F.lit(AFTER)).alias("head"), F.right(g, F.lit(BEFORE)).alias("tail")))
    found = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.monotonically_increasing_id().alias("row"),
        wholes.alias("wholes"),
        ends.alias("gaps"),
    ).filter(F.size("wholes") > 0)
    places = found.select("doc_id", "path", "row", F.posexplode(F.arrays_zip("wholes", "gaps")).alias("i", "at")).select("doc_id", "path", "row", "i", F.col("at.wholes").alias("whole"), F.col("at.gaps").alias("gap"))
    given = F.regexp_extract("whole", "^" + ASSIGNED + "[\"']?", 0)
    is_given = (F.length("given") > 0) & (F.length("given") < F.length("whole"))
    prefix = F.when(is_given, F.col("given")).otherwise(F.regexp_extract("whole", r"^[A-Za-z_.-]+=+", 0))
    name = F.when(is_given, F.regexp_extract("whole", r"^([A-Za-z0-9_.-]+)", 1)).otherwise(F.regexp_extract("whole", r"^([A-Za-z_.-]+)=", 1))
    rest = F.substr("whole", F.length("prefix") + 1)
    unquoted = F.when(F.col("prefix").rlike("[\"']$"), F.regexp_replace(rest, "[\"']$", "")).otherwise(F.regexp_replace(rest, "[\"'.,;]+$", ""))
    value = F.when(F.col("whole").startswith("-----BEGIN "), F.col("whole")).when(F.col("is_given"), unquoted).otherwise(F.regexp_replace(rest, r"[.=]+$", ""))
    places = places.withColumn("given", given).withColumns({"is_given": is_given, "prefix": prefix, "name": name}).withColumn("value", value)
    order = Window.partitionBy("row").orderBy("i")
    until = F.sum(F.col("gap.size") + F.coalesce(F.length("whole"), F.lit(0))).over(order) - F.length("whole")
    ahead = F.array_join(F.collect_list(F.concat(F.col("gap.tail"), F.coalesce(F.right("whole", F.lit(BEFORE)), F.lit("")))).over(order.rowsBetween(-BEFORE, -1)), "")
    behind = F.array_join(F.collect_list(F.concat(F.col("gap.head"), F.coalesce(F.left("whole", F.lit(AFTER)), F.lit("")))).over(order.rowsBetween(1, AFTER)), "")
    before = F.right(F.concat(ahead, F.col("gap.tail"), F.when(F.col("is_given"), F.col("prefix")).otherwise("")), F.lit(BEFORE))
    after = F.left(F.concat(F.substr(rest, F.length("value") + 1), behind), F.lit(AFTER))
    placed = places.select("doc_id", "path", (until + F.length("prefix")).cast("long").alias("start"), "value", "name", before.alias("before"), after.alias("after"), "is_given")
    return placed.filter((F.length("value") >= LEAST) | (F.col("is_given") & (F.length("value") > 0))).drop("is_given")


def add_features(found: DataFrame, triples: DataFrame) -> DataFrame:
    """Candidates with the columns of FEATURES and ``kind``. Coverage is computed once per different value."""
    value = F.col("value")
    size = F.length(value).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    values = found.select("value").distinct()
    pieces = values.filter(F.length("value") >= 3).select("value", F.explode(_triples(lower_ascii(value))).alias("triple"))
    known = triples.withColumn("known", F.lit(1))
    covered = pieces.join(F.broadcast(known), "triple", "left").groupBy("value").agg(F.avg(F.coalesce("known", F.lit(0))).alias("coverage"))
    kind = F.lit("assigned")
    for label, pattern in PROVIDERS.items():
        kind = F.when(value.rlike(pattern), label).otherwise(kind)
    named = F.col("name").rlike(NAMES)
    near = F.col("before").rlike(NAMES)
    columns = {
        "length": size,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "marks": share("[^A-Za-z0-9]"),
        "changes": share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[^A-Za-z0-9])[A-Za-z0-9]"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / size,
        "hexadecimal": value.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "path_example": F.col("path").rlike("(?i)test|example|sample|fixture|doc").cast("double"),
        "named": named.cast("double"),
        "named_near": near.cast("double"),
        "assigned": (F.col("before").rlike(r"[=:]\s*[\"']?$") | (F.col("name") != "")).cast("double"),
        "quoted": F.col("before").rlike("[\"']$").cast("double"),
        "kind": F.when(kind != "assigned", kind).when(named | near, "assigned").otherwise("string"),
    }
    return found.withColumns(columns).join(covered, "value", "left").fillna({"coverage": 0.0})


def rule_labels(featured: DataFrame) -> DataFrame:
    """Labelled findings (value, label) where tables carry no labels: provider forms and named assignments against harmless forms.

    What fits neither is left to the forest.
    """
    provider = ~F.col("kind").isin("assigned", "string")
    mixed = (F.col("digits") > 0.1) & (F.col("digits") < 0.95) & (F.col("coverage") < 0.5)
    secret = provider | ((F.col("named") + F.col("named_near") > 0) & (F.col("assigned") > 0) & mixed)
    label = F.when(F.col("value").rlike(HARMLESS), 0.0).when(secret, 1.0)
    return featured.select("value", label.alias("label")).filter("label is not null").groupBy("value").agg(F.min("label").alias("label"))


def draw_sample(values: DataFrame, sample: int) -> tuple[DataFrame, list[float]]:
    """About ``sample`` values of each label at most, one at least, and all labels there are.

    ``weight`` is how many labelled values a drawn one stands for.
    """
    digest = F.pmod(F.xxhash64("value"), F.lit(1 << 20))
    labels = values.groupBy("label").agg(F.count("*").alias("n"), F.min(digest).alias("least")).orderBy("label").limit(3).collect()
    drawn, weight = F.lit(False), F.lit(1.0)
    for r in labels:
        mine = F.col("label") == r.label
        drawn = drawn | (mine & ((digest * r.n < sample << 20) | (digest == r.least)))
        weight = F.when(mine, max(1.0, r.n / max(1, sample))).otherwise(weight)
    return values.filter(drawn).withColumn("weight", weight), [r.label for r in labels]


def scan_secrets(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", path: str = "source", sample: int = SAMPLE) -> DataFrame:
    """Candidates with doc_id, start, length, kind, value_sha256, score and is_secret.

    ``labels`` has (value, label 0 or 1); without it ``rule_labels`` makes them. A value
    that occurs several times in one text is a finding at each place. Null text
    has none, null path is empty. Repeated rows repeat their findings. Where the labels
    have only one kind, every finding gets that label as score; without any, score is 0.
    An empty table gives an empty result.
    """
    found = settle(find_candidates(docs, doc_id, text, path))
    featured = settle(add_features(found, dictionary_triples(docs, text)))
    named = (labels if labels is not None else rule_labels(featured)).select("value", F.col("label").cast("double").alias("label"))
    values = featured.groupBy("value").agg(*[F.avg(f).alias(f) for f in FEATURES]).join(named, "value")
    values = settle(values.filter("label is not null"))
    chosen, kinds = draw_sample(values, sample)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    if len(kinds) < 2:
        scored = featured.withColumn("score", F.lit(kinds[0] if kinds else 0.0))
    else:
        training = settle(assembler.transform(chosen.orderBy("value")).select("features", "label", "weight").coalesce(1))
        # The copy has no training summary, whose session does not go to the tasks once it has observed a frame.
        forest = RandomForestClassifier(weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(training).copy()
        scored = forest.transform(assembler.transform(featured)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", F.length("value").alias("length"), "kind", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", (F.col("score") >= DECISION).alias("is_secret"))
