"""Secret scans: candidates by pattern, false positives removed by a random forest; DataFrame functions only.

One pattern finds candidates: known key shapes unless a letter or digit stands before them, values assigned to names like
``token``, ``password`` or ``SECRET_KEY``, and long mixed strings, which end where one of the former begins.  ``regexp_replace`` puts marks around them and ``split`` cuts the text there, which keeps the exact places and
both neighbourhoods of each candidate.  A candidate is the whole run of its characters, however long.  The forest sees
the candidate's length, character transitions, coverage by dictionary words, character shares, paths and neighbouring
words.  It is trained on labelled findings on the driver (at most ``MAX_FINDINGS`` rows, a stated bound) and applied as
data: its trees are literal arrays that a fold walks, so scoring is an expression like any other and texts stay on the
JVM.  There is no shuffle.

No table here holds labelled findings, so ``labelled_findings`` makes a seeded set of the usual kinds of secrets and of
what is mistaken for them; a DataFrame of one's own with the columns before, candidate, after, label does as well.

Defined results: null or empty text has no findings and stays as it is; the marks U+0001 and U+0002 in a text count as
spaces; rows repeating a doc_id are scanned each; a null doc_id is carried along; other columns are kept by ``redact``
and ignored by ``findings``.
"""

from __future__ import annotations

import random
import string
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_FINDINGS = 20_000
REDACTED = "[SECRET]"

_NAMES = "pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?:orization)?|bearer|credentials?"
#: Shapes of keys as their issuers publish them.
_SHAPES = [
    "(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])",
    "gh[pousr]_[A-Za-z0-9]{20,}+",
    "xox[abprs]-[A-Za-z0-9-]{10,}+",
    "eyJ[A-Za-z0-9_-]{10,}+\\.[A-Za-z0-9_-]{10,}+\\.[A-Za-z0-9_-]{5,}+",
]
#: What may stand between such a name and the sign: ``_key``, ``_id``, ``Key``, ``_v2``.
_SUFFIX = "(?:[_-][A-Za-z0-9]{1,16}|key|id){0,3}"
_ASSIGNED = f"""(?i:(?:{_NAMES}){_SUFFIX})["']?\\s{{0,3}}[:=]\\s{{0,3}}["']?"""
_VALUE = "[A-Za-z0-9+/_=.~@%^&*!$#-]"
#: A fixed shape may follow any sign, for example in a path or behind ``=``.
_FIXED = f"(?<![A-Za-z0-9])(?:{'|'.join(_SHAPES)})"
#: A long mixed string starts where its run or the candidate before it ends, and goes up to the next such candidate.
_RUN, _STOP = "A-Za-z0-9+/_=-", f"{_FIXED}|{_ASSIGNED}{_VALUE}{{8}}"
_MIXED = f"(?:(?<![{_RUN}])|\\G)(?=[{_RUN}]{{32}})(?=(?:(?!{_STOP})[A-Za-z+/_=-])*+[0-9])(?:(?!{_STOP})[{_RUN}]){{32,}}+"
PATTERN = f"({_ASSIGNED})({_VALUE}{{8,}}+)|({_FIXED}|{_MIXED})"
_OPEN, _CLOSE = "\x01", "\x02"

#: Words that make a string look written rather than drawn.
DICTIONARY = (
    "access account admin alpha and api application article auth base beta bucket build change changeme class client cloud code "
    "commit common config content controller count create data database default delete dev document domain dummy element email "
    "enable endpoint entity error event example fake field file filter format from function get handler hash header here host "
    "image index info input insert instance item key label language last lib list local log long main manager message method "
    "model module my name network new next node null object option order output page param password path placeholder policy "
    "previous private process product profile project public query random read record redacted region request resource response "
    "result role root sample secret section server service session set site source stack state static status storage string "
    "style super system table tag target task temp template test text the this time title token type undefined update url user "
    "util validate value variable version view web with word world write xxx your"
).split()
_GOOD, _BAD = f"(?i)(?:{_NAMES})", "(?i)example|sample|dummy|placeholder|fake|test|commit|sha|md5|checksum|uuid|digest|revision|etag|version|integrity"

FEATURES = ["length", "transitions", "coverage", "digits", "upper", "symbols", "hex", "distinct", "path", "extension", "assigned", "good", "bad", "shape", "named"]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def features_sql(before: str, value: str, after: str) -> str:
    """SQL of the feature array of a candidate, from SQL of its neighbourhood."""

    def count(pattern: str, of: str = value) -> str:
        return f"cast(size(regexp_extract_all({of}, {_quoted(pattern)}, 0)) as double)"

    def flag(pattern: str, of: str) -> str:
        return f"if(regexp_like({of}, {_quoted(pattern)}), 1D, 0D)"

    near, ahead, size = f"right({before}, 48)", f"left({after}, 48)", f"cast(char_length({value}) as double)"
    left = f"regexp_replace(lower({value}), {_quoted('|'.join(sorted(DICTIONARY, key=lambda w: (-len(w), w))))}, '')"
    return "array(" + ", ".join([
        size,
        count("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") + f" / {size}",
        f"1D - char_length({left}) / {size}",
        count("[0-9]") + f" / {size}",
        count("[A-Z]") + f" / {size}",
        count("[^A-Za-z0-9]") + f" / {size}",
        flag("^[0-9a-fA-F]+$", value),
        f"size(array_distinct(split({value}, ''))) / {size}",
        count(r"[/\\]", f"concat({near}, {value})"),
        flag(r"^\.[A-Za-z]{2,4}\b", after),
        flag("[:=]\\s*[\"']?$", near),
        flag(_GOOD, near),
        flag(_BAD, f"concat({near}, ' ', {ahead})"),
        flag(f"^(?:{'|'.join(_SHAPES)})$", value),
        flag(f"(?i)(?:{_NAMES}){_SUFFIX}[\"']?\\s*[:=]\\s*[\"']?$", near),
    ]) + ")"


class Forest(NamedTuple):
    """Complete trees in heap order from place 1: feature (from 1) and threshold of inner nodes, value of leaves."""

    depth: int
    trees: list[tuple[list[int], list[float], list[float]]]

    def sql(self, x: str) -> str:
        """SQL of the mean vote of the trees over the feature array ``x``."""
        trees = ", ".join(
            f"named_struct('f', array({', '.join(map(str, f))}), 't', array({', '.join(f'{v!r}D' for v in t)}), 'v', array({', '.join(f'{v!r}D' for v in leaf)}))"
            for f, t, leaf in self.trees
        )
        steps = ", ".join(map(str, range(self.depth)))
        leaf = f"aggregate(array({steps}), 1, (n, _) -> 2 * n + if(element_at({x}, element_at(tree.f, n)) <= element_at(tree.t, n), 0, 1))"
        return f"aggregate(array({trees}), 0D, (votes, tree) -> votes + element_at(tree.v, {leaf} - {2**self.depth - 1})) / {len(self.trees)}D"


def train_forest(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 6, seed: int = 3) -> Forest:
    """Bootstrap trees; each node takes the best Gini split among the thresholds of a random third of the features."""
    draw, out = np.random.default_rng(seed), []
    for _ in range(trees):
        feature, threshold, leaves = [1] * (2**depth - 1), [float("1e18")] * (2**depth - 1), [0.0] * 2**depth
        nodes = {1: draw.integers(0, len(y), len(y))}
        for node in range(1, 2 ** (depth + 1)):
            rows = nodes.pop(node, None)
            share = float(y[rows].mean()) if rows is not None and len(rows) else 0.5
            if node >= 2**depth:
                leaves[node - 2**depth] = round(share, 6)
                continue
            best = (np.inf, 0, 1e18)
            if rows is not None and 0 < share < 1:
                for f in draw.choice(x.shape[1], max(2, x.shape[1] // 3), replace=False):
                    order = np.argsort(x[rows, f], kind="stable")
                    v, ones = x[rows[order], f], np.cumsum(y[rows[order]])
                    n = np.arange(1, len(rows))
                    a, b = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(rows) - n)
                    cost = np.where(v[1:] > v[:-1], n * a * (1 - a) + (len(rows) - n) * b * (1 - b), np.inf)
                    if len(cost) and cost.min() < best[0]:
                        k = int(cost.argmin())
                        best = (cost[k], int(f), float((v[k] + v[k + 1]) / 2))
            feature[node - 1], threshold[node - 1] = best[1] + 1, best[2]
            rows = np.zeros(0, int) if rows is None else rows
            left = x[rows, best[1]] <= best[2]
            if len(rows) and left.all():  # a pure node hands its rows to both sides, so every leaf below has its vote
                nodes[2 * node] = nodes[2 * node + 1] = rows
            else:
                nodes[2 * node], nodes[2 * node + 1] = rows[left], rows[~left]
        out.append((feature, threshold, leaves))
    return Forest(depth, out)


def labelled_findings(n: int = 3000, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """(before, candidate, after, label): drawn secrets, and strings that patterns take for secrets."""
    r = random.Random(seed)
    mixed, hexed, upper = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_uppercase + string.digits

    def drawn(alphabet: str, low: int, high: int) -> str:
        return "".join(r.choices(alphabet, k=r.randint(low, high)))

    def word() -> str:
        """One of the dictionary's, or one that it has not: coverage alone must not tell secrets from names."""
        if r.random() < 0.6:
            return r.choice(DICTIONARY)
        return "".join(r.choice("bcdfghklmnprstvw") + r.choice(["a", "e", "i", "o", "u", "er", "en", "al"]) for _ in range(r.randint(2, 4)))

    def words(k: int, by: str = " ") -> str:
        return by.join(word() for _ in range(k))

    def prose() -> str:
        return " ".join(drawn(string.ascii_lowercase, 2, 9) for _ in range(r.randint(3, 9)))

    name = lambda: r.choice(["token", "password", "secret", "api_key", "auth_token", "pwd", "access_key"])
    sign = lambda: r.choice(["=", ": ", " = ", ' = "', '="', ": '"])
    secrets = [
        lambda: (prose() + " ", r.choice(["AKIA", "ASIA"]) + drawn(upper, 16, 16)),
        lambda: (prose() + " ", "gh" + r.choice("pousr") + "_" + drawn(mixed, 36, 36)),
        lambda: (prose() + " ", "xoxb-" + drawn(string.digits, 11, 12) + "-" + drawn(mixed, 24, 24)),
        lambda: (prose() + " ", "eyJ" + drawn(mixed, 20, 60) + "." + drawn(mixed + "_-", 30, 90) + "." + drawn(mixed + "_-", 43, 43)),
        lambda: (prose() + f" {name()}{sign()}", drawn(hexed, 16, 64)),
        lambda: (prose() + f" {name()}{sign()}", drawn(mixed, 12, 48)),
        lambda: (prose() + f" {name()}{sign()}", drawn(mixed + "+/", 32, 64) + "=" * r.randint(0, 2)),
        lambda: (prose() + f" {name()}{sign()}", drawn(mixed + "!@#$%^&*", 10, 20)),
        lambda: (prose() + " ", drawn(mixed + "+/", 40, 64)),
    ]
    others = [
        lambda: (f"{prose()} {r.choice(['commit', 'revision', 'sha'])} ", drawn(hexed, 40, 40)),
        lambda: (f"{prose()} {r.choice(['md5: ', 'sha256:', 'checksum=', 'digest: ', 'etag: '])}", drawn(hexed, 32, 64)),
        lambda: (f"{prose()} uuid ", "-".join(drawn(hexed, k, k) for k in (8, 4, 4, 4, 12))),
        lambda: (prose() + f" {name()}{sign()}", r.choice(["changeme", "password", "your_token_here", "xxxxxxxxxxxx", "example-secret", "placeholder", "undefined", "redacted"])),
        lambda: (prose() + f" {name()}{sign()}", words(r.randint(2, 4), r.choice("_-."))),
        lambda: (prose() + f" {name()}{sign()}", words(1) + "." + words(1) + "_" + words(1)),
        lambda: (prose() + " /" + words(2, "/") + "/", words(r.randint(4, 7), r.choice("/-_")) + drawn(string.digits, 1, 3)),
        lambda: (prose() + " https://" + words(1) + ".com/", words(r.randint(5, 8), "-") + "-" + drawn(string.digits, 1, 4)),
        lambda: (prose() + " ", "".join(w.title() for w in words(r.randint(5, 8)).split()) + drawn(string.digits, 1, 2)),
        lambda: (prose() + " ", drawn(string.digits, 32, 40)),
        lambda: (prose() + " ", r.choice("=-_") * r.randint(32, 60) + drawn(string.digits, 1, 1)),
        lambda: (prose() + f" example {name()}{sign()}", drawn("0123456789", 8, 10)),
    ]
    out = []
    for i in range(n):
        label = i % 2
        before, value = r.choice(secrets if label else others)()
        if label and r.random() < 0.08 and "eyJ" not in value:
            before, value = before.upper(), value.upper()
        # texts around either kind hold words that merely contain a telling one
        chance = [r.choice(["shadow", "attest", "committee", "digestion", "aversion", "counterfake", "geisha", "unsampled"]) + " " if r.random() < 0.25 else "" for _ in range(2)]
        out.append((chance[0] + before, value, r.choice(['" ', "' ", " ", "\n", ""]) + chance[1] + prose(), label))
    return out


def fit(spark: SparkSession, labelled: DataFrame | None = None) -> Forest:
    """A forest from labelled findings (before, candidate, after, label); the features are those of the scan."""
    if labelled is None:
        labelled = spark.createDataFrame(labelled_findings(), "before string, candidate string, after string, label int")
    rows = labelled.where("candidate <> '' and label is not null")
    rows = rows.orderBy(F.xxhash64("before", "candidate", "after", "label"), "before", "candidate", "after", "label").limit(MAX_FINDINGS)
    rows = rows.select(F.expr(features_sql("coalesce(before, '')", "candidate", "coalesce(after, '')")).alias("x"), "label").collect()
    x, y = np.array([r["x"] for r in rows], float), np.array([r["label"] for r in rows], float)
    return train_forest(x.reshape(len(rows), len(FEATURES)), y)


def _parts(text: Column) -> Column:
    """The text cut before each candidate; a part but the first is candidate, mark, what follows."""
    clean = F.translate(text, _OPEN + _CLOSE, "  ")
    return F.when(clean.rlike(PATTERN), F.split(F.regexp_replace(clean, F.lit(PATTERN), F.lit(f"$1{_OPEN}$2$3{_CLOSE}")), _OPEN)).otherwise(F.array(clean))


def _found(forest: Forest) -> Column:
    """From the array ``_parts``: one struct per candidate."""
    before = "replace(element_at(_parts, i), '\\u0002', '')"
    value, after = "substring_index(element_at(_parts, i + 1), '\\u0002', 1)", "substring(element_at(_parts, i + 1), locate('\\u0002', element_at(_parts, i + 1)) + 1)"
    bare = f"transform(if(size(_parts) > 1, sequence(1, size(_parts) - 1), cast(array() as array<int>)), i -> named_struct('nth', i, 'before', {before}, 'value', {value}, 'after', {after}))"
    scored = f"transform({bare}, c -> named_struct('nth', c.nth, 'value', c.value, 'x', {features_sql('c.before', 'c.value', 'c.after')}))"
    return F.expr(f"transform({scored}, c -> named_struct('nth', c.nth, 'value', c.value, 'kind', {_kind('c.value')}, 'score', {forest.sql('c.x')}))")


def _kind(value: str) -> str:
    names = ("cloud_key", "forge_token", "chat_token", "web_token")
    return "case " + " ".join(f"when regexp_like({value}, {_quoted('^(?:' + s + ')$')}) then '{n}'" for s, n in zip(_SHAPES, names, strict=True)) + " else 'value' end"


def _scanned(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows as one struct, so that no column of theirs can clash, and their parts and candidates."""
    rows = docs.select(F.struct("*").alias("_row")).withColumn("_parts", _parts(F.col("_row.text").cast("string")))
    return rows.withColumn("_found", _found(forest))


def findings(docs: DataFrame, forest: Forest | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, nth, start (code points from 0), length, kind, value_sha256, score, is_secret for each candidate."""
    forest = forest or fit(docs.sparkSession)
    rows = _scanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), forest).where("size(_parts) > 1")
    # starts are running sums of lengths, kept per block of the square root of their number so that long lists stay cheap
    rows = rows.withColumn("_lengths", F.expr("transform(_parts, p -> char_length(p))")).withColumn("_block", F.expr("cast(ceil(sqrt(size(_parts))) as int)"))
    rows = rows.withColumn("_sums", F.expr("transform(sequence(0, size(_parts) div _block), b -> aggregate(slice(_lengths, b * _block + 1, _block), 0, (n, x) -> n + x))"))
    rows = rows.withColumn("_sums", F.expr("transform(sequence(0, size(_parts) div _block), b -> aggregate(slice(_sums, 1, b), 0, (n, x) -> n + x))"))
    start = "_sums[f.nth div _block] + aggregate(slice(_lengths, f.nth div _block * _block + 1, f.nth % _block), 0, (n, x) -> n + x) - (f.nth - 1)"
    ahead = F.expr(f"transform(_found, f -> named_struct('f', f, 'start', {start}))")
    return rows.select("_row.doc_id", F.explode(ahead).alias("r")).select(
        "doc_id", F.col("r.f.nth").cast("long").alias("nth"), F.col("r.start").cast("long").alias("start"), F.char_length("r.f.value").cast("long").alias("length"),
        F.col("r.f.kind").alias("kind"), F.sha2("r.f.value", 256).alias("value_sha256"), F.round("r.f.score", 6).alias("score"), (F.col("r.f.score") >= threshold).alias("is_secret"),
    )


def redact(docs: DataFrame, forest: Forest | None = None, threshold: float = 0.5) -> DataFrame:
    """The same rows and columns with each secret in ``text`` replaced by ``[SECRET]``."""
    forest = forest or fit(docs.sparkSession)
    rest = "substring(element_at(_parts, f.nth + 1), locate('\u0002', element_at(_parts, f.nth + 1)) + 1)"
    safe = f"concat(element_at(_parts, 1), array_join(transform(_found, f -> concat(if(f.score >= {threshold!r}D, '{REDACTED}', f.value), {rest})), ''))"
    # texts without a secret are returned as they came, marks included
    text = F.when(F.exists("_found", lambda f: f["score"] >= threshold), F.expr(safe)).otherwise(F.col("_row.text"))
    return _scanned(docs, forest).withColumn("_row", F.col("_row").withField("text", text)).select("_row.*")
