"""Secret scans: candidate strings, and a random forest that tells secrets from numbers, hashes, hosts and paths.

DataFrame functions only. Candidates are values assigned to a credential word or sent in an authorization header, keys of a
published form, and runs of token characters that hold a digit. Each carries its surroundings; its features are its length, its characters and their transitions, how much of it
common words cover, what it has of a path, and the words beside it. The forest is trained from labelled findings, a bounded
sample of them, and is left with those candidates that look like secrets.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.store import saved

SHORTEST, SHORTEST_ASSIGNED = 16, 8
CREDENTIAL = r"(?:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?"
HEADER = r"(?i:authorization[\"']?\s{0,3}[:=]\s{0,3}[\"']?(?:bearer|basic|token)\s{1,3})"
ASSIGN = rf"(?:{HEADER}|(?i:{CREDENTIAL})[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?)"
RUN = r"A-Za-z0-9+/_.=\-"
# Published forms of access keys, which name themselves.
KNOWN = "|".join([
    r"(?:AKIA|ASIA)[0-9A-Z]{16}",
    r"gh[oprsu]_[0-9A-Za-z]{36}",
    r"github_pat_[0-9A-Za-z_]{82}",
    r"glpat-[0-9A-Za-z_\-]{20}",
    r"xox[abeoprs]-[0-9A-Za-z\-]{10,200}",
    r"[rs]k_(?:live|test)_[0-9A-Za-z]{24,99}",
    r"AIza[0-9A-Za-z_\-]{35}",
    r"eyJ[0-9A-Za-z_\-]{10,}+\.eyJ[0-9A-Za-z_\-]{10,}+\.[0-9A-Za-z_\-]{10,}+",
])
CANDIDATE = (rf"{ASSIGN}[^\s\"'<>]{{{SHORTEST_ASSIGNED},}}"
             rf"|(?<![{RUN}])(?:{KNOWN})(?![0-9A-Za-z])"
             rf"|(?<![{RUN}])(?=[A-Za-z+/_.=\-]*+[0-9])[{RUN}]{{{SHORTEST},}}")
BEFORE, AFTER = 40, 20
MOST_LABELLED = 20_000
TREES, DEPTH, SEED = 20, 6, 17
LEAST_SCORE = 0.5
MASK = "[SECRET]"

# Frequent words and word parts of English, French, German and Spanish, for the share of a string they cover.
COMMON = ("the and for that with from this have not are was you all can one out use get set new data file name user "
          "time test home page http https www com org net html index image main list item type code line example "
          "tion ment ing ness able ight ough ever less ship ward hood "
          "der die das und ein eine nicht mit von zu auf ist ung heit keit lich isch schaft "
          "les des une dans que qui pour par sur pas eau eux ation ement elle "
          "los las una por con del para como ción dad mente ado ando iendo").split()


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start and stop (characters, from 0), value, before, after: every candidate of every whole text.

    A text is cut at the matches of one pattern; what lies between them gives places and surroundings.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    cut = cut.filter(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", "row", F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), F.lit(1)).alias("hits"),
        F.split("text", CANDIDATE, -1).alias("gaps"))
    each = F.transform("hits", lambda hit, i: F.struct(
        i.alias("number"), hit.alias("hit"), F.length(F.col("gaps")[i]).alias("gap"),
        F.right(F.col("gaps")[i], F.lit(BEFORE)).alias("before"), F.left(F.col("gaps")[i + 1], F.lit(AFTER)).alias("after")))
    rows = cut.select("doc_id", "row", F.inline(each))
    until = F.sum(F.col("gap") + F.length("hit")).over(
        Window.partitionBy("row").orderBy("number").rowsBetween(Window.unboundedPreceding, 0))
    lead = F.regexp_extract("hit", f"^(?:{ASSIGN})", 0)
    return (rows.withColumn("stop", until).withColumn("lead", lead)
            .select("doc_id", (F.col("stop") - F.length("hit") + F.length("lead")).alias("start"), "stop",
                    F.expr("substr(hit, length(lead) + 1)").alias("value"),
                    F.concat("before", "lead").alias("before"), "after"))


def _share(pattern: str) -> Column:
    """Matches of a pattern in the value, per character."""
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def features() -> dict[str, Column]:
    """Numbers about a candidate, in the order of the forest's inputs."""
    lower = F.lower("value")
    covered = 1 - F.length(F.regexp_replace(lower, "|".join(sorted(COMMON, key=len, reverse=True)), "")) / F.length("value")
    kinds = {"digits": "[0-9]", "upper": "[A-Z]", "lower": "[a-z]", "hex": "[0-9a-fA-F]", "other": "[^0-9A-Za-z]",
             "letter_to_digit": "[A-Za-z](?=[0-9])", "digit_to_letter": "[0-9](?=[A-Za-z])", "case_changes": "[a-z](?=[A-Z])|[A-Z](?=[a-z])",
             "vowel_pairs": "(?i)[bcdfghjklmnpqrstvwxyz](?=[aeiou])", "consonant_runs": "(?i)[bcdfghjklmnpqrstvwxyz]{4,}",
             "same_pairs": r"(.)(?=\1)"}
    near = {"credential_before": rf"(?i:{CREDENTIAL}[^A-Za-z]{{0,8}}$)|{HEADER}$", "assigned": r"[:=]\s{0,3}[\"']?$", "quoted": r"[\"']$",
            "hash_before": r"(?i)(sha\d*|md5|commit|checksum|digest|hash|uuid|rev)[^A-Za-z]{0,8}$",
            "place_before": r"(?i)(https?:/{0,2}|www\.|@|/)\S{0,30}$",
            "number_before": r"(?i)(phone|tel|card|iban|isbn|order|invoice|id|no)\W{0,4}$"}
    flag = {"path": r"/.*/|^/|\\", "extension": r"\.[A-Za-z]{2,4}$", "only_digits": r"^[0-9.+\-]+$", "uuid":
            r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$", "placeholder": r"(?i)(x{4,}|example|sample|your|dummy|changeme|0{6,}|123456)"}
    return ({"length": F.log(F.length("value").cast("double")),
             "distinct": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"), "dictionary": covered}
            | {k: _share(p) for k, p in kinds.items()}
            | {k: F.col("value").rlike(p).cast("double") for k, p in flag.items()}
            | {k: F.col("before").rlike(p).cast("double") for k, p in near.items()}
            | {"closing_quote": F.col("after").rlike(r"^[\"']").cast("double")})


def with_features(found: DataFrame) -> DataFrame:
    return found.select("*", *[c.cast("double").alias(f"f_{n}") for n, c in features().items()])


def likely_labels(found: DataFrame) -> DataFrame:
    """Labelled findings where no reviewed ones are at hand: `label` by rules of high precision, null where they say nothing.

    1: a value of high variety assigned to a credential word, no placeholder. 0: numbers, paths, hosts, e-mail parts,
    strings that common words cover, hashes named as such, placeholders.
    """
    varied = (F.col("f_length") >= F.log(F.lit(20.0))) & (F.col("f_digits") > 0.1) & (F.col("f_digits") < 0.9)
    secret = (F.col("f_credential_before") == 1) & varied & (F.col("f_placeholder") == 0) & (F.col("f_path") == 0)
    harmless = reduce(lambda a, b: a | b, [F.col(f"f_{n}") == 1 for n in (
        "only_digits", "extension", "path", "place_before", "hash_before", "uuid", "placeholder")]) | (F.col("f_dictionary") > 0.5)
    return found.withColumn("label", F.when(secret, 1).when(harmless & (F.col("f_credential_before") == 0) & ~names_itself(), 0))


def names_itself() -> Column:
    """The value is an access key by its published form, and no placeholder."""
    return F.col("value").rlike(f"^(?:{KNOWN})$") & (F.col("f_placeholder") == 0)


def forest_scores(found: DataFrame, labelled: DataFrame, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """found with `score`, the forest's share for a secret. Both tables come from with_features; labelled has `label` 0 or 1.

    At most `most_labelled` findings of each class are learnt from, the same ones whenever the table is the same. With
    class 0 only, a value with a credential word before it scores 1 and any other 0, by the rules of likely_labels; with
    class 1 only, or none, there is nothing to tell apart: every score is then 1, and no finding is removed.
    """
    inputs = [f"f_{n}" for n in features()]
    place = F.xxhash64("value", "before", "after", "doc_id", "start")
    taken = reduce(DataFrame.unionByName, [
        labelled.filter(F.col("label") == c).select(*inputs, F.col("label").cast("double").alias("label"), place.alias("place"))
        .orderBy("place", *inputs).limit(most_labelled) for c in (0, 1)])
    taken = saved(taken.orderBy("place").drop("place"), "labelled")
    classes = {row["label"] for row in taken.select("label").distinct().collect()}
    if classes == {0.0}:
        return found.withColumn("score", (F.col("f_credential_before") == 1).cast("double"))
    if len(classes) < 2:
        return found.withColumn("score", F.lit(1.0))
    gather = VectorAssembler(inputCols=inputs, outputCol="inputs")
    forest = RandomForestClassifier(featuresCol="inputs", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    model = forest.fit(gather.transform(taken))
    scored = model.transform(gather.transform(found))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*found.columns, "score")


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         most_labelled: int = MOST_LABELLED) -> DataFrame:
    """doc_id, start, stop, value, before, after, score, secret: all candidates of docs with the forest's verdict.

    labelled: reviewed findings (doc_id, start, value, before, after, label), by which alone the forest then decides; without
    them likely_labels of the candidates themselves, and keys of a published form are secrets at any score. Null, empty and blank texts have no candidates; a null id stays null; repeated rows are
    scanned each; other columns are ignored.
    """
    found = saved(with_features(candidates(docs, id_col, text_col)), "findings")
    known = likely_labels(found).filter("label is not null") if labelled is None else with_features(labelled)
    sure = names_itself() if labelled is None else F.lit(False)
    return forest_scores(found, known, most_labelled).select(
        "doc_id", "start", "stop", "value", "before", "after", "score", ((F.col("score") >= LEAST_SCORE) | sure).alias("secret"))


def redacted(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with every secret value found in a document replaced by MASK wherever it stands in it.

    Longer values are replaced first. A document has as many values as it holds secrets. Documents without one stay
    as they are; rows of one id share their values; null ids match null ids.
    """
    key, found = (f"{name}_{uuid.uuid4().hex}" for name in ("id", "values"))  # no column of docs can have these names
    values = findings.filter("secret").groupBy(F.col("doc_id").alias(key)).agg(F.collect_set("value").alias(found))
    longest_first = F.reverse(F.array_sort(F.transform(found, lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))))
    joined = docs.join(values, F.col(id_col).cast("long").eqNullSafe(F.col(key)), "left")
    masked = F.aggregate(longest_first, F.col(text_col), lambda text, v: F.replace(text, v["v"], F.lit(MASK)))
    return joined.withColumn(text_col, F.when(F.col(found).isNull(), F.col(text_col)).otherwise(masked)).select(*docs.columns)
