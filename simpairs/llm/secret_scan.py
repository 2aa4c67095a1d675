"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a maximal run of 14 or more ASCII letters, digits and
``+ / _ -``, whatever stands beside it; only the part of a run that touches a
further Latin letter (``ü``) belongs to a word and is left out. Behind a
hinting word and an assignment, any value of 6 or more bytes is one too.
The forest sees its length, its character transitions (mean log-probability
of its byte pairs among all texts, and changes of character class), how much
of it dictionary words cover (the corpus's own frequent words), the path it
comes from, and its neighbouring words. It is trained on labelled findings;
candidates it rejects are the false positives.

Pair and word counts cover all documents (partial sums per batch, then a
shuffle by key); words inside candidates do not count. A dictionary word makes
up at least ``RATE`` of all words, so the dictionary has at most ``1 / RATE``
words whatever the corpus, and means the same at every size. It, the 65,536
pair counts, the bounded training sample and the forest are all that passes
through the driver. Work is in proportion to the bytes of a text or candidate,
and both are read in blocks.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm import common
from simpairs.session import materialize, ship_package

LEAST, SHORTEST = 14, 6  # bytes of a candidate, and of an assigned value behind a hinting word
CANDIDATE = re.compile(rb"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_-]{%d,}={0,2}(?![A-Za-z0-9])" % LEAST)
JOINTS = re.compile(rb"[+/_-]")
#: a word goes on beside these; punctuation, symbols and letters of other scripts end it
LATIN = regex.compile(r"[\p{Latin}\u0300-\u036f]")
ASSIGNMENTS = ("=", ":", "\uff1d", "\uff1a")  # the last two are full-width
QUOTES = ("\"", "'", *"`\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f\u00ab\u00bb\u2039\u203a\u300c\u300d\u300e\u300f\uff02\uff07")
_SIGNS, _OPEN = ("|".join(re.escape(c) for c in a).encode() for a in (ASSIGNMENTS, QUOTES))
ASSIGN = re.compile(rb"(?:%s)+>?" % _SIGNS)
OPEN = re.compile(rb"\s*(?:%s)?" % _OPEN)
#: what may stand between a hinting word and its assignment
CLOSED = re.compile(rb"([\w-]+)(?:%s)?\s*$" % _OPEN)
#: an assigned value, which ends before white space, quotes, brackets and further punctuation
VALUE = regex.compile(r"(?:[\p{L}\p{M}\p{N}!#$%*+\-./:=?@\\^_|~]|&(?![\w-]+=))+")
WORD = re.compile(rb"[a-z]+")
LETTERS, NO_LETTER = re.compile(rb"[A-Za-z]+"), re.compile(rb"[^A-Za-z]")
NEAR = re.compile(rb"[\w-]+")
#: words that introduce a secret
HINTS = (b"password", b"passwd", b"pwd", b"secret", b"token", b"key", b"apikey", b"api_key", b"auth", b"credential")
SHORT, LONG = 3, 40  # letters of a dictionary word
RATE = 1e-5  # share of all words that makes a word a dictionary word; there are at most 1 / RATE
BLOCK = 1 << 20  # bytes of a text or candidate that are looked at together
SAMPLE = 5000  # labelled findings of each kind the forest is trained on
TREES, DEPTH, SEED = 40, 8, 2020
PATH_CODES = 16

FOUND = ("start long, length long, finding string, hinted int, assigned int, quoted int, before_letters int, "
         "after_letters int, digits double, upper double, changes double, pairs double, coverage double")
FEATURES = ["length", "pairs", "changes", "digits", "upper", "coverage", "path_code", "path_depth", "path_length",
            "hinted", "assigned", "quoted", "before_letters", "after_letters"]


def _word_blocks(text: bytes):
    """A text in lower case, in blocks that end where a word does."""
    at = 0
    while at < len(text):
        end = NO_LETTER.search(text, at + BLOCK)
        end = end.start() if end else len(text)
        yield text[at:end].lower()
        at = end


def _overlapping(data: bytes):
    """Blocks of bytes; each starts with the last byte of the one before, so each pair is in one."""
    for at in range(0, max(1, len(data) - 1), BLOCK):
        yield np.frombuffer(data, np.uint8, min(BLOCK + 1, len(data) - at), at)


def _pairs(block: np.ndarray) -> np.ndarray:
    wide = block.astype(np.uint16)
    return wide[:-1] << 8 | wide[1:]


def _outside(text: bytes, spans: list[tuple[int, int]]):
    """The parts of a text between its candidates."""
    at = 0
    for start, end in spans:
        if start > at:
            yield text[at:start]
        at = max(at, end)
    yield text[at:] if at else text


def _counts(batches):
    """``(key, n)``: words outside candidates, and byte pairs as ``#<number>``, summed per batch."""
    for batch in batches:
        words: Counter = Counter()
        pairs = np.zeros(1 << 16, np.int64)
        held, size = [], 0

        def add():
            for block in _overlapping(b"\n".join(held)) if held else ():
                pairs[:] += np.bincount(_pairs(block), minlength=1 << 16)

        for text in common.byte_texts(batch.column("text")):
            if not text:
                continue
            for part in _outside(text, places(text)):
                for block in _word_blocks(part):
                    words.update(w for w in WORD.findall(block) if SHORT <= len(w) <= LONG)
            held.append(text)
            size += len(text)
            if size > BLOCK:
                add()
                held, size = [], 0
        add()
        at = np.flatnonzero(pairs)
        keys = [w.decode() for w in words] + [f"#{i}" for i in at]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()),
                                          pa.array([*words.values(), *pairs[at].tolist()], pa.int64())], names=["key", "n"])


def _kinds(token: np.ndarray) -> np.ndarray:
    """0 lower case, 1 upper case, 2 digit, 3 other."""
    return np.where((token >= 97) & (token <= 122), 0, np.where((token >= 65) & (token <= 90), 1,
                    np.where((token >= 48) & (token <= 57), 2, 3)))


def _shape(data: bytes, likely: np.ndarray) -> tuple[float, float, float, float]:
    """Shares of digits, capitals and class changes, and the mean of ``likely`` over the byte pairs."""
    sums = np.zeros(4)
    for number, block in enumerate(_overlapping(data)):
        kinds = _kinds(block)
        own = kinds[int(number > 0):]
        sums += ((own == 2).sum(), (own == 1).sum(), (kinds[1:] != kinds[:-1]).sum(), likely[_pairs(block)].sum())
    n = max(1, len(data) - 1)
    return sums[0] / len(data), sums[1] / len(data), sums[2] / n, sums[3] / n


class Dictionary:
    """Words of ``SHORT`` letters and more, found at a place by their first letters."""

    def __init__(self, words):
        self.words = frozenset(words)
        lengths: dict[bytes, set] = {}
        for w in self.words:
            lengths.setdefault(w[:SHORT], set()).add(len(w))
        self.lengths = {head: sorted(found, reverse=True) for head, found in lengths.items()}

    def covered(self, data: bytes) -> int:
        """Bytes of ``data`` (any case) that lie inside a word."""
        n = 0
        for run in LETTERS.finditer(data):
            low, reach = run.group().lower(), 0
            for i in range(len(low) - SHORT + 1):
                for length in self.lengths.get(low[i:i + SHORT], ()):
                    if i + length <= len(low) and low[i:i + length] in self.words:
                        n += max(0, i + length - max(reach, i))
                        reach = max(reach, i + length)
                        break
        return n


def _whole(text: bytes, start: int, end: int) -> tuple[int, int]:
    """The run ``start`` … ``end`` without its parts that touch a Latin letter beyond ASCII."""
    if start and text[start - 1] > 127 and LATIN.match(text[max(0, start - 4):start].decode(errors="ignore")[-1:]):
        joint = JOINTS.search(text, start, end)
        start = joint.end() if joint else end
    if end < len(text) and text[end] > 127:
        follows = text[end:end + 4].decode(errors="ignore")[:1]
        if text[end - 1:end] == b"=" and follows.isalnum():  # an assignment, no padding
            end = start + len(text[start:end].rstrip(b"="))
        elif LATIN.match(follows):
            joints = [m.start() for m in JOINTS.finditer(text, start, end)]
            end = joints[-1] if joints else start
    return start, end


def _value(text: bytes, start: int) -> int:
    """End of the value that begins at ``start``; no more text is decoded than it takes."""
    size = 256
    while True:
        part = text[start:start + size].decode(errors="replace")
        value = VALUE.match(part)
        if not value or len(value.group()) < len(part) - 4 or start + size >= len(text):
            return start + len(value.group().rstrip(".:?").encode()) if value else start
        size *= 4


def _assigned(text: bytes):
    """Places of values behind a hinting word and an assignment; they do not overlap."""
    at = 0
    while m := ASSIGN.search(text, at):
        at = m.end()
        word = CLOSED.search(text[max(0, m.start() - 40):m.start()])
        if word and any(h in word.group(1).lower() for h in HINTS):
            start = OPEN.match(text, m.end()).end()
            end = _value(text, start)
            if end - start >= SHORTEST:
                yield start, end
                at = end


def places(text: bytes) -> list[tuple[int, int]]:
    """Start and end of all candidates of a text, in order."""
    runs = (_whole(text, *m.span()) for m in CANDIDATE.finditer(text))
    found = {(a, b) for a, b in runs if b - a >= LEAST}
    found.update(_assigned(text))
    return sorted(found)


def _scan(shared, schema: pa.Schema):
    """Candidates of each batch; ``shared`` holds the chances of byte pairs and the dictionary."""
    signs, quotes = (tuple(c.encode() for c in a) for a in (ASSIGNMENTS, QUOTES))

    def rows(batch):
        likely, words = shared.value
        for doc_id, path, text in zip(batch.column("doc_id"), batch.column("path"), common.byte_texts(batch.column("text"))):
            for start, end in places(text or b""):
                token = text[start:end]
                before = text[max(0, start - 40):start]
                after = text[end:end + 40]
                near = NEAR.findall(before)
                last = near[-1].lower() if near else b""
                gap = before[before.rfind(near[-1]) + len(near[-1]):] if near else before
                following = NEAR.search(after)
                yield (doc_id.as_py(), path.as_py(), start, len(token), token.decode(),
                       int(any(h in last for h in HINTS)), int(any(c in gap for c in signs)),
                       int(gap.endswith(quotes)), int(last.isalpha()),
                       int(bool(following) and following.group().isalpha()),
                       *_shape(token, likely), words.covered(token) / len(token))

    def run(batches):
        for batch in batches:
            yield from common.in_slices(rows(batch), schema, 5000, weigh=lambda row: row[3])

    return run


def candidates(docs: DataFrame, path: str = "source", rate: float = RATE) -> DataFrame:
    """Candidates with their place, text and features, one row each.

    ``path`` names the column that tells where a document comes from. Words
    that make up ``rate`` of all words outside candidates are the dictionary.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", F.col(f"`{path}`").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    counts = materialize(rows.select("text").mapInArrow(_counts, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")))
    table = np.ones(1 << 16)  # each pair counts once more than seen
    for r in counts.filter("key LIKE '#%'").collect():  # at most 65,536 rows
        table[int(r["key"][1:])] += r["n"]
    table = table.reshape(256, 256)
    words = counts.filter(~F.col("key").startswith("#"))
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter(F.col("n") >= F.lit(rate * total)).select("key").collect()  # at most 1 / rate rows
    shared = spark.sparkContext.broadcast((np.log2(table / table.sum(axis=1, keepdims=True)).ravel(),
                                           Dictionary(r["key"].encode() for r in frequent)))
    ddl = f"doc_id {common.sql_type(rows, 'doc_id')}, path string, {FOUND}"
    found = rows.mapInArrow(_scan(shared, common.arrow_schema(ddl, spark)), ddl)
    path_text = F.coalesce(F.col("path"), F.lit(""))
    return (found
            .withColumn("path_code", F.pmod(F.xxhash64(path_text), F.lit(PATH_CODES)).cast("int"))
            .withColumn("path_depth", F.size(F.split(path_text, "/")))
            .withColumn("path_length", F.length(path_text)))


def training_rows(labelled: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """At most ``sample`` distinct ``(finding, features)`` of each kind, with their ``label``.

    First (``again`` 0) one row of each finding, then (1) further ones, both
    by a hash (``place``). A window over the rows of a finding would put a
    common one into one task, so both parts are aggregates and top rows.
    """
    rows = (labelled.filter("is_secret IS NOT NULL").select("finding", F.col("is_secret").cast("double").alias("label"), *FEATURES)
            .distinct().withColumn("place", F.xxhash64(F.lit(seed), "finding", *FEATURES)))
    order = ["place", "finding", *FEATURES]
    firsts = (rows.groupBy("finding", "label").agg(F.min(F.struct("place", *FEATURES)).alias("row"))
              .select("finding", "label", "row.*"))
    parts = [part.withColumn("again", F.lit(again)).filter(F.col("label") == kind).orderBy(*order).limit(sample)
             for kind in (1.0, 0.0) for again, part in ((0, firsts), (1, rows))]
    both = parts[0].unionByName(parts[1]), parts[2].unionByName(parts[3])
    once = [b.groupBy("label", *order).agg(F.min("again").alias("again")).orderBy("again", *order).limit(sample) for b in both]
    return once[0].unionByName(once[1])


def train(labelled: DataFrame, sample: int = SAMPLE, seed: int = SEED):
    """Random forest from candidates with a boolean ``is_secret``; None without both kinds.

    At most ``sample`` rows of each kind are used. Rows equal in finding and
    features are one; each distinct finding gives one row before any gives a
    second, and rows are taken by a hash, so neither copies nor the order of
    rows decide what the forest learns from.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    drawn = materialize(training_rows(labelled, sample, seed))
    if drawn.select("label").distinct().count() < 2:
        return None
    ordered = drawn.orderBy("label", "again", "place", "finding", *FEATURES).coalesce(1)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(ordered)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, labelCol="label", featuresCol="features")
    return forest.fit(vectors.select("features", "label"))


def judge(found: DataFrame, model) -> DataFrame:
    """``found`` with ``score`` (the forest's probability of a secret) and ``is_secret`` (score of half or more).

    Without a model nothing can be ruled out: score null, ``is_secret`` true.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if model is None:
        return found.withColumn("score", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(found)
    model = model.copy().setFeaturesCol("_features").setProbabilityCol("_probability")
    return (model.transform(vectors).withColumn("score", vector_to_array("_probability")[1])
            .withColumn("is_secret", F.col("score") >= F.lit(0.5)).select(*found.columns, "score", "is_secret"))


def format_labels(found: DataFrame) -> DataFrame:
    """Labelled findings where a format decides: ``found`` with ``is_secret`` true, false or null (undecided).

    True: access key ids of the public AKIA format, and hexadecimal values of
    18 or more digits assigned to a hinting word. False: letters only, in
    words, and digits only.
    """
    f = F.col("finding")
    secret = f.rlike("^AKIA[0-9A-Z]{16}$") | (f.rlike("^(?=.*[0-9])[0-9a-f]{18,}$") & (F.col("hinted") == 1) & (F.col("assigned") == 1))
    plain = f.rlike("^[A-Za-z]+$") | f.rlike("^[0-9]+$")
    return found.withColumn("is_secret", F.when(secret, True).when(plain, False))


def reviewed(findings: DataFrame):
    """Labels from a table of reviewed findings, as ``secrets`` takes them.

    ``findings`` has ``is_secret`` and either ``finding`` or, where secrets
    must not be stored, ``finding_sha256`` (lowercase hex). Null labels say
    nothing; a finding that was ever marked as a secret is one.
    """
    by = "finding" if "finding" in findings.columns else "finding_sha256"
    marks = findings.filter("is_secret IS NOT NULL").groupBy(by).agg(F.max("is_secret").alias("is_secret"))

    def labels(found: DataFrame) -> DataFrame:
        keyed = found if by == "finding" else found.withColumn(by, F.sha2("finding", 256))
        return keyed.join(marks, by).select(*found.columns, "is_secret")

    return labels


def secrets(docs: DataFrame, labelled=format_labels, path: str = "source", learn_from=None, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, path, start, length, finding, score, is_secret)``, one row per candidate.

    ``start`` and ``length`` count bytes of the UTF-8 text. ``labelled`` maps
    candidates to labelled findings (``is_secret``, null: no label), for
    example ``reviewed(table)``; ``learn_from`` is a condition on
    candidates that the forest may learn from. Null and empty texts have no
    candidates; a null path is an empty one; repeated rows give repeated
    findings; texts are searched whole. An empty table gives no rows, and
    without labels of both kinds nothing is ruled out.
    """
    found = materialize(candidates(docs, path))
    known = labelled(found if learn_from is None else found.filter(learn_from))
    out = judge(found, train(known, sample))
    return out.select("doc_id", "path", "start", "length", "finding", "score", "is_secret")
