"""Secret scanning with native expressions: patterns propose, a random forest removes false findings.

Proposals are, in this order at any place: a block of a private key, a signed web token, the password of a connection string, a value of at
least six characters assigned to a name that speaks of secrets (quoted or not), and a run of at least sixteen letters, digits and / + _ - with a
digit in it. What a proposal covers is not proposed again. The forest looks at its length, the kinds of its
characters and how often they change, how far common letter sequences of the corpus cover it, the path of the document, and the words before it. It is trained on
labelled findings; where there are none at hand, `obvious` labels the proposals whose nature is plain. The corpus' letter
sequences are counted over all documents; the forest is fitted on a bounded sample of labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.documents import quoted
from tabwright.sources.shared import durable

# Looking back has a fixed width in every alternative, which each engine reads alike, and comes after a look at the last one or two characters,
# which rules out nearly every place at once.
NAMES = ["pwd", "token", "passwd|secret|apikey", "api[_-]key|authkey", "password|auth[_-]key", "accesskey", "passphrase|credential|privatekey|access[_-]key", "private[_-]key"]
NAME = "(?:" + "|".join(f"(?<=(?:{n}){end})" for end in ("", "s", "[_-]key", "[_-]id") for n in NAMES) + ")"
BETWEEN = r"[\x22\x27\x20\t=:>]"
ASSIGNS = r"[\x22\x27]?[\x20\t]{0,8}(?:=>|:=|=|:)[\x20\t]{0,8}[\x22\x27]?"
# behind a name and all that stands between it and the place, which holds one sign of assignment
ASSIGNED = "(?i:" + "|".join(rf"(?<=(?={ASSIGNS}(?!{BETWEEN})){NAME}{BETWEEN}{{{n}}})" for n in range(1, 21)) + ")"
USER = "(?:" + "|".join(rf"(?<=://[A-Za-z0-9._%+-]{{{n}}}:)" for n in range(1, 65)) + ")"
#: Forms of proposals, in the order in which they are tried at a place. Quantifiers are possessive or bounded, so that no text takes more than linear time.
FORMS = {
    "key_block": r"-----BEGIN [A-Z ]{0,40}+PRIVATE KEY-----[A-Za-z0-9/+=\x20\x09-\x0D]*+",
    "web_token": r"(?<![A-Za-z0-9/+_.-])eyJ[A-Za-z0-9_-]{5,}+\.eyJ[A-Za-z0-9_-]{5,}+\.[A-Za-z0-9_-]*+",
    "connection": rf"(?<=:){USER}[^\x20\x09-\x0D:/@\x22\x27<>]{{3,}}+(?=@)",
    "assigned": rf"(?<={BETWEEN})(?<![^\x22\x27\x20\t=:>][\x20\t])(?!eyJ[A-Za-z0-9_-]{{5,}}+\.eyJ)(?=[^\x20\x09-\x0D\x22\x27<>,;(){{}}\[\]:=]){ASSIGNED}"
                r"[^\x20\x09-\x0D\x22\x27<>,;(){}\[\]]{6,}+",
    "run": r"(?<![A-Za-z0-9/+_-])(?=[A-Za-z/+_-]*+[0-9])[A-Za-z0-9/+_-]{16,}+={0,2}+",
}
PROPOSAL = "(?:" + "|".join(FORMS.values()) + ")"
SECRET_WORDS = "passw|pwd|secret|token|api.?key|access.?key|auth|credential|private"
HARMLESS_WORDS = "sha|commit|hash|checksum|uuid|md5|version|card|order|phone|invoice|isbn"
TEST_PATHS = "test|example|sample|mock|fixture|docs?/"
NEAR = 40
SEQUENCES = 1_000
TRAINING_ROWS = 20_000
THRESHOLD = 0.5
FEATURES = ["length", "digits", "upper", "lower", "symbols", "changes", "distinct", "coverage", "test_path", "path_depth", "secret_word", "harmless_word", "assigned", "quoted_value"]


def proposals(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, path, start, stop, value, before) for every proposal; start and stop in code points, before: the text ahead of it."""
    rows = docs.select(quoted(id).alias("doc_id"), quoted(path).cast("string").alias("path"), quoted(text).alias("text"))
    rows = rows.withColumn("values", F.expr(f"regexp_extract_all(text, r'{PROPOSAL}', 0)")).where("size(values) > 0")
    rows = rows.withColumn("pieces", F.expr(f"split(text, r'{PROPOSAL}', -1)")).drop("text")
    long = rows.select("doc_id", "path", F.expr("transform(arrays_zip(pieces, values), x -> struct(x.values as value, right(x.pieces, 40) as before, char_length(x.pieces) as gap)) as found"))
    # starts are sums of what comes before; sums over blocks of 128 first
    sizes = "transform(sequence(0, (size(found) - 1) div 128), b -> transform(slice(found, b * 128 + 1, 128), x -> x.gap + coalesce(char_length(x.value), 0)))"
    more = "(a, v) -> concat(a, array(element_at(a, -1) + v))"
    long = long.withColumn("blocks", F.expr(sizes)).withColumn("bases", F.expr(f"aggregate(transform(blocks, x -> aggregate(x, 0, (a, v) -> a + v)), array(0), {more})"))
    long = long.withColumn("stops", F.expr(f"flatten(transform(blocks, (x, b) -> slice(aggregate(x, array(bases[b]), {more}), 2, size(x))))"))
    one = long.select("doc_id", "path", F.explode(F.arrays_zip("found", "stops")).alias("x")).where("x.found.value is not null")
    return one.selectExpr("doc_id", "path", "x.stops - char_length(x.found.value) as start", "x.stops as stop", "x.found.value as value", "x.found.before as before")


def sequences(docs: DataFrame, text: str = "text", size: int = SEQUENCES) -> list[str]:
    """The letter triples that are most frequent in the words of all documents, as a dictionary."""
    words = docs.select(F.explode(F.split(F.lower(quoted(text)), "[^a-z]+")).alias("word")).where("length(word) >= 3").groupBy("word").agg(F.count("*").alias("n"))
    triples = words.select(F.explode(F.expr("transform(sequence(1, length(word) - 2), i -> substr(word, i, 3))")).alias("triple"), "n")
    return [r.triple for r in triples.groupBy("triple").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "triple").limit(size).collect()]


def with_features(found: DataFrame, known: list[str]) -> DataFrame:
    """Proposals with the numbers the forest looks at."""
    share = lambda kind: f"length(regexp_replace(value, '[^{kind}]', '')) / length(value)"
    kinds = "regexp_replace(regexp_replace(regexp_replace(value, '[a-z]+', 'a'), '[A-Z]+', 'A'), '[0-9]+', '9')"
    triples = "filter(transform(sequence(1, length(value) - 2), i -> lower(substr(value, i, 3))), x -> x rlike '^[a-z]{3}$')"
    found = found.withColumn("known", F.array(*map(F.lit, known)) if known else F.expr("cast(array() as array<string>)"))
    exprs = {
        "length": "cast(length(value) as double)", "digits": share("0-9"), "upper": share("A-Z"), "lower": share("a-z"), "symbols": share("/+_="),
        "changes": f"length({kinds}) / length(value)", "distinct": "size(array_distinct(split(value, ''))) / length(value)",
        "coverage": f"size(filter({triples}, x -> array_contains(known, x))) / (length(value) - 2)",
        "test_path": f"if(lower(path) rlike '{TEST_PATHS}', 1D, 0D)", "path_depth": "cast(length(path) - length(replace(path, '/', '')) as double)",
        "secret_word": f"if(lower(before) rlike '{SECRET_WORDS}', 1D, 0D)", "harmless_word": f"if(lower(before) rlike '{HARMLESS_WORDS}', 1D, 0D)",
        "assigned": r"""if(before rlike r'[=:]\s*["\']?$', 1D, 0D)""".replace(r"\'", "\\x27"), "quoted_value": r"""if(before rlike r'["\x27]$', 1D, 0D)"""}
    return found.withColumns({k: F.coalesce(F.expr(v).cast("double"), F.lit(0.0)) for k, v in exprs.items()}).drop("known")


def obvious(found: DataFrame) -> DataFrame:
    """Proposals whose nature is plain, with label: 1 for a provider's key format or a mixed value assigned to a secret's name; 0 for digits only
    and for readable words joined by symbols without such a name before. All others have no label."""
    secret = r"value rlike '^(AKIA|ASIA)[A-Z0-9]{16}$' or value rlike '^gh[pousr]_[A-Za-z0-9]{36}' or (secret_word = 1 and assigned = 1 and digits between 0.1 and 0.95)"
    harmless = "digits >= 0.99 or (secret_word = 0 and (harmless_word = 1 or coverage >= 0.25 and digits < 0.2))"
    return found.withColumn("label", F.expr(f"case when {secret} then 1D when {harmless} then 0D end")).where("label is not null")


def fit(labelled: DataFrame, rows: int = TRAINING_ROWS):
    """A forest from at most about `rows` labelled findings, chosen by hash; None unless there are findings of either kind."""
    counts = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    if set(counts) < {0.0, 1.0}:
        return None
    share = min(1.0, rows / sum(counts.values()))
    chosen = labelled.where(f"pmod(xxhash64(value, before, start), 1000000) < {share * 1e6}")
    # a bounded sample, in one order, so that the same findings always give the same forest
    chosen = durable(chosen.select("label", *FEATURES, "value", "start").repartition(1).sortWithinPartitions("value", "start", *FEATURES), "findings")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=40, maxDepth=8, seed=1, subsamplingRate=1.0)
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen).select("label", "features"))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = "source", findings: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, stop, probability, is_secret) for every proposal of every row of a table of documents.

    findings: labelled findings with the columns of `with_features` and label (0 or 1); without, the documents' own obvious ones. If there are
    none of one kind, every proposal is a secret with probability 0.5. A null or empty text has no proposals, a null path or text before no features.
    Rows are scanned each for itself, so repeated rows give repeated findings; an empty table gives an empty result.
    """
    known = sequences(docs, text)
    found = durable(with_features(proposals(docs, id, text, path), known), "proposals")
    model = fit(obvious(found) if findings is None else findings)
    out = ["doc_id", "start", "stop"]
    if model is None:
        return found.select(*out, F.lit(0.5).alias("probability"), F.lit(True).alias("is_secret"))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    probability = F.round(vector_to_array("probability")[1], 9)
    return scored.select(*out, probability.alias("probability"), (probability >= THRESHOLD).alias("is_secret"))
