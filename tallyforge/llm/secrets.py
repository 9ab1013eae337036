"""Secret scan with a random forest that removes false positives (operator 9).

Everything on the main path is a DataFrame expression: candidates are cut out
of whole texts by one regular expression, described by columns (length,
character transitions, dictionary coverage, path and neighbouring words), and
scored by the forest, which is compiled to one column expression. The forest is
trained in numpy on a bounded table of labelled findings; without one, a
generated table in the same format is used.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import trees

_KEY = "A-Za-z0-9+/_-"
# an assignment (x=, x: , x = ", "x":") or a word for a secret just before, with blanks or tabs between; every test has a fixed width
_ASSIGNED = "|".join(f"(?<=[=:][ \\t]{{{n}}}{quote})" for n in range(9) for quote in ("", "[\"'`]"))
_WORDS = "token secret password passwd passphrase passcode pwd apikey api[_-]key bearer auth credential".split()
_ANNOUNCED = "|".join(f"(?<=(?i:{word})[ \\t]{{{n}}})" for word in _WORDS for n in range(1, 5))
_VALUE = rf"[@!$%#&*{_KEY}](?:[.@!$%#&*~^{_KEY}]*[@!$%#&*{_KEY}])?"
#: a run of key characters with nothing of the kind beside it, which has 16 or more and a digit (runs joined by dots are one), or what follows an assignment or a word for a secret
CANDIDATE = rf"(?<![{_KEY}])(?:(?=[A-Za-z+/_-]*+[0-9])[{_KEY}]{{16,}}(?:\.[{_KEY}]{{16,}})*|(?<=[=: \t\"'`])(?:{_ASSIGNED}|{_ANNOUNCED}){_VALUE})={{0,2}}(?![={_KEY}])"
#: characters that mark the begin and the end of a candidate
MARKS = "\x01\x02"
#: characters of the text kept before and after a candidate
BEFORE, AFTER = 48, 24

# Words that a dictionary would cover in keys, paths and names.
DICTIONARY = "access account admin alpha apache api app archive asset auth authorization basic bearer beta book build cache card class client cloud code com common config content core data date default demo dev dist doc docs download dummy edit error event example export false file final first font foo form from green group guide home host html http https image img import index info input item java json key lib library light link list local login main map mark media menu meta model module name net new news none note null number object old open option order org output page part password path photo plan play post print private product profile project public query raw read release report required resource result root sample script secret section server service session set share shop site size small source src staging start static status store string style super support system table tag temp test text theme time title token tool top true type update upload user util value version video view web widget window word work world xml year your zone".split()
COMMON_PAIRS = "th he in er an re nd at on nt ha es st en ed to it ou ea hi is or ti as te et ng of al de se le sa si ar ve ra ld ur io ic ll ne me li ri ro co".split()
KEYWORDS = r"(?:token|secret|passw|passphrase|passcode|pwd|api[_-]?key|apikey|access[_-]?key|auth|bearer|credential|private[_-]?key|client[_-]?id)"
OTHERS = r"(?:commit|revision|sha-?1|sha-?256|md5|checksum|digest|uuid|guid|isbn|card|phone|tel|order|invoice|version|build|example|sample|dummy|page|fig)"


def features(candidate: Column, before: Column, after: Column) -> dict[str, Column]:
    n = F.length(candidate)
    low = F.lower(candidate)
    letters = F.greatest(F.length(F.regexp_replace(candidate, "[^A-Za-z]", "")), F.lit(1))
    uncovered = F.length(F.regexp_replace(F.regexp_replace(low, "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))), ""), "[^a-z]", ""))

    def share(keep: str) -> Column:
        return F.length(F.regexp_replace(candidate, f"[^{keep}]", "")) / n

    left = F.lower(before)
    return {
        "length": n.cast("double"),
        "digit_share": share("0-9"),
        "upper_share": share("A-Z"),
        "hex_share": share("0-9a-fA-F"),
        "transitions": F.regexp_count(candidate, F.lit("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]")) / n,
        "common_pairs": F.regexp_count(low, F.lit("(?=(?:" + "|".join(COMMON_PAIRS) + "))")) / letters,
        "dictionary": 1 - uncovered / letters,
        "separators": F.regexp_count(candidate, F.lit("[/_-]")) / n,
        "path": F.when(F.contains(candidate, F.lit("/")) | before.rlike(r"(?:://|[./\\])[^\s]*$") | after.rlike(r"^\.[A-Za-z]{2,5}\b"), 1.0).otherwise(0.0),
        "uuid": F.when(candidate.rlike("^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"), 1.0).otherwise(0.0),
        "assigned": F.when(before.rlike(r"[=:]\s*[\"'`]?$"), 1.0).otherwise(0.0),
        "quoted": F.when(before.rlike(r"[\"'`]$") & after.rlike("^[\"'`]"), 1.0).otherwise(0.0),
        "keyword": F.when(left.rlike(KEYWORDS), 1.0).otherwise(0.0),
        "other_word": F.when(left.rlike(OTHERS), 1.0).otherwise(0.0),
    }


FEATURES = "length digit_share upper_share hex_share transitions common_pairs dictionary separators path uuid assigned quoted keyword other_word".split()


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate: doc_id, finding (its number in the text, from 1), candidate, before, after.

    One pass of the pattern puts marks around the candidates; the parts between
    marks are the candidates and what stands around them.
    """
    # characters of the text that are marks themselves are replaced; no candidate has them
    marked = F.regexp_replace(F.translate(F.col(text_col), MARKS, "\ufffd\ufffd"), f"({CANDIDATE})", f"{MARKS[0]}$1{MARKS[1]}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), marked.alias("marked")).where(F.contains("marked", F.lit(MARKS[0])))
    parts = rows.select("doc_id", F.split("marked", f"[{MARKS}]", -1).alias("p"))
    at = F.transform(F.sequence(F.lit(0), F.floor(F.size("p") / 2).cast("int") - 1), lambda k: F.struct(F.get("p", 2 * k - 1).alias("previous"), F.get("p", 2 * k).alias("between"), F.get("p", 2 * k + 1).alias("found"), F.get("p", 2 * k + 2).alias("following")))
    zipped = parts.select("doc_id", F.posexplode(at).alias("at", "x"))
    return zipped.select(
        "doc_id",
        (F.col("at") + 1).cast("long").alias("finding"),
        F.col("x.found").alias("candidate"),
        F.right(F.concat(F.right(F.coalesce("x.previous", F.lit("")), F.lit(BEFORE)), F.right(F.col("x.between"), F.lit(BEFORE))), F.lit(BEFORE)).alias("before"),
        F.left(F.col("x.following"), F.lit(AFTER)).alias("after"),
    )


@dataclass(frozen=True)
class Forest:
    trees: tuple

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.mean([trees.values(t, x) for t in self.trees], axis=0)

    def column(self, names: list[str] = FEATURES) -> Column:
        return F.expr("(" + " + ".join(trees.as_sql(t, names) for t in self.trees) + f") / {len(self.trees)}D")


def fit(x: np.ndarray, y: np.ndarray, *, n_trees: int = 16, depth: int = 5, seed: int = 7) -> Forest:
    """Bootstrapped trees, each node choosing among a random third of the features."""
    if not len(y):
        return Forest((0.5,))
    draw, grown = np.random.default_rng(seed), []
    for _ in range(n_trees):
        rows = draw.integers(0, len(y), len(y))
        xs, ys = x[rows], y[rows].astype(float)
        cuts = trees.cut_points(xs)
        pick = lambda: draw.choice(x.shape[1], max(2, x.shape[1] // 3), replace=False)
        grown.append(trees.grow(xs, ys, np.ones(len(ys)), cuts, depth, 3, pick))
    return Forest(tuple(grown))


def generated_findings(n: int = 2000, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """Labelled findings by rule: (candidate, before, after, 1 for a secret)."""
    draw = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def some(characters: str, least: int, most: int) -> str:
        return "".join(draw.choice(characters) for _ in range(draw.randint(least, most)))

    def word() -> str:
        return draw.choice(DICTIONARY)

    def prose() -> str:
        return " ".join("".join(draw.choice(COMMON_PAIRS) for _ in range(draw.randint(1, 4))) for _ in range(6))

    def assigned() -> tuple[str, str]:
        name = draw.choice(["token", "secret", "password", "api_key", "apikey", "access_key", "auth_token", "client_secret", "TOKEN", "API_KEY", "Bearer", "AWS_SECRET_ACCESS_KEY", "access_token"])
        quote = draw.choice(['"', "'", ""])
        return f"{prose()} {name}{draw.choice([' = ', '=', ': ', ':'])}{quote}", f"{quote} {prose()}"

    def announced() -> tuple[str, str]:
        return f"{prose()} {draw.choice(['token', 'secret', 'password', 'Bearer', 'credential', 'auth'])} ", f" {prose()}"

    def plain() -> tuple[str, str]:
        return f"{prose()} ", f" {prose()}"

    out = []
    for k in range(n):
        if k % 2:
            kind = draw.randrange(9)
            c = some("0123456789abcdef", 32, 64) if kind == 0 else some("0123456789ABCDEF", 32, 64) if kind == 1 else "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 16) if kind == 2 else some(alnum, 20, 64) if kind == 3 else some(alnum + "+/", 40, 44) + "=" if kind == 4 else some(alnum[:52], 16, 40) if kind == 5 else some(alnum, 9, 15) if kind == 6 else some(alnum, 4, 8) + draw.choice("@!$%") + some(alnum + "@!$%", 4, 16) + draw.choice(alnum) if kind == 7 else ".".join(["eyJ" + some(alnum + "_-", 17, 40), some(alnum + "_-", 20, 90), some(alnum + "_-", 43, 43)])
            b, a = announced() if draw.random() < 0.1 else assigned() if draw.random() < 0.9 or kind in (0, 1, 5, 6, 7) else plain()
            out.append((c, b[-BEFORE:], a[:AFTER], 1))
        else:
            kind = draw.randrange(10)
            b, a = plain()
            if kind == 0:
                c = some("0123456789", 16, 20)
            elif kind == 1:
                c, b = some("0123456789abcdef", 40, 40), f"{prose()} {draw.choice(['commit', 'sha1', 'revision', 'checksum', 'md5'])} "
            elif kind == 2:
                h = "0123456789abcdef"
                c = "-".join(some(h, m, m) for m in (8, 4, 4, 4, 12))
                b = b if draw.random() < 0.5 else f"{prose()} uuid: "
            elif kind == 3:
                c, a = "/".join(word() for _ in range(4)) + str(draw.randint(1, 99)), ".html " + a
            elif kind == 4:
                c = draw.choice("_-").join(word() for _ in range(4)) + str(draw.randint(1, 999))
                b = f"{prose()} {word()} = " if draw.random() < 0.5 else b
            elif kind == 5:
                c = "".join(draw.choice(COMMON_PAIRS) for _ in range(draw.randint(8, 12))) + str(draw.randint(0, 99))
            elif kind == 7:
                # words and numbers after an assignment, or after a word for a secret in prose
                c = draw.choice([draw.choice([str.lower, str.capitalize, str.upper])(word()), "".join(draw.choice(COMMON_PAIRS) for _ in range(draw.randint(1, 6))), some("0123456789", 1, 12)])
                b, a = (f"{prose()} {word()}{draw.choice([' = ', '=', ': ', ':'])}", a) if draw.random() < 0.5 else announced() if draw.random() < 0.5 else assigned()
            elif kind == 8:
                c, a = draw.choice(["", "//"]) + "/".join(word() for _ in range(draw.randint(1, 4))), draw.choice([".html", ".com"]) + a
                b = f"{prose()} {word()}{draw.choice([' = ', '=', ': ', ':'])}"
            elif kind == 9:
                c = draw.choice("_-").join(word() for _ in range(draw.randint(2, 3)))
                b, a = assigned()
            else:
                c = f"your-{word()}-{word()}-here-{draw.randint(1, 999)}"
                b, a = assigned()
            out.append((c, b[-BEFORE:], a[:AFTER], 0))
    return [(c, b, a, y) for c, b, a, y in out if c in re.findall(CANDIDATE, b + c + a)]


def labelled(spark: SparkSession, findings: list[tuple[str, str, str, int]] | None = None) -> DataFrame:
    return spark.createDataFrame(findings if findings is not None else generated_findings(), "candidate string, before string, after string, label int")


def train(findings: DataFrame, *, most_rows: int = 20_000) -> Forest:
    """Fit on at most ``most_rows`` labelled findings (candidate, before, after, label)."""
    made = features(F.col("candidate"), F.coalesce("before", F.lit("")), F.coalesce("after", F.lit("")))
    rows = findings.where("candidate is not null and candidate <> '' and label in (0, 1)").select(*(made[k].cast("double").alias(k) for k in FEATURES), "label")
    data = np.array([tuple(r) for r in rows.orderBy(*FEATURES, "label").limit(most_rows).collect()], float).reshape(-1, len(FEATURES) + 1)
    return fit(data[:, :-1], data[:, -1].astype(int))


def scan(docs: DataFrame, *, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, finding, candidate, score, is_secret and the features.

    ``is_secret`` is score >= ``threshold``; the rest are the false positives
    removed. Null and empty texts have no candidates; repeated rows repeat
    theirs; null ids are kept. Other columns are not read. An empty table
    gives no rows.
    """
    forest = train(findings if findings is not None else labelled(docs.sparkSession))
    found = candidates(docs, id_col=id_col, text_col=text_col)
    made = features(F.col("candidate"), F.col("before"), F.col("after"))
    described = found.select("doc_id", "finding", "candidate", *(made[k].cast("double").alias(k) for k in FEATURES))
    scored = described.withColumn("score", forest.column())
    return scored.select("doc_id", "finding", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"), *FEATURES)
