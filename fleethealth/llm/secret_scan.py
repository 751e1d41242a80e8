"""Secrets in texts: candidate strings judged by a random forest.

A candidate is the whole value that is assigned to a name (up to its quote or
white space), what follows ``Bearer``, a JSON web token, a PEM private key block,
or a run of letters, digits and ``_+/-`` of 8 or more characters with a digit in
it. Candidates may lie in each other; what is masked is the union of those that
are judged secret. The forest looks at its length, the transitions between its
characters, how much of it dictionary words cover, the path (source) and the
neighbouring words. It is trained on labelled findings and removes the false
positives among the candidates.

Findings may come from reviewers (columns value, before, after, path, label).
``weak_findings`` makes them from the documents by strict format rules over all
documents and keeps a sample of at most ``max_rows`` by hash. Dictionary and
transition counts cover all documents.

Texts may be null or empty (no candidates). Every occurrence of a repeated
candidate is judged by its own neighbours. Fixed examples of both labels are
always among the training rows, so the forest has trees whatever the input holds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fleethealth.llm.store import small_batches, staged

CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/\-])[A-Za-z_+/\-]*+[0-9][A-Za-z0-9_+/\-]*+={0,2}")
#: A private key up to its end line; without one, its base64 lines.
PEM = re.compile(
    r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:[^-]*+(?:-(?!----(?:BEGIN|END))[^-]*+)*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{16,})*+)")
JWT = re.compile(r"(?<![A-Za-z0-9_.\-])eyJ[A-Za-z0-9_-]{10,}+(?:\.[A-Za-z0-9_-]++){0,4}")
BEARER = re.compile(r"(?<!\w)(?:[Bb]earer|BEARER)\s+([A-Za-z0-9._~+/-]{6,}+=*)")
SIGN = re.compile(r"(?::=|=>|==?|:)\s{0,16}")
VALUE = re.compile(
    r'\\"((?:[^"\\\n]|\\[^"\n])++)\\"|'
    r'"((?:[^"\\\n]|\\.)++)"' r"|'((?:[^'\\\n]|\\.)++)'" r"|`([^`\n]++)`"
    r"""|\\?["'`]?(?:(?:Bearer|Basic|Token|Digest)\s+)?((?:[^\s"'`\\]|["'`](?=\w)|\\(?!["'`]))++)""")
LEAST = 8
SHORT = 4  # of a value assigned to a name that is not a telling one
NEAR = 48
MASK = "[SECRET]"
MAX_ROWS = 20_000
TREES, DEPTH, LEAF = 40, 7, 3
EXAMPLES = 120
HELD = 200_000
RARE = 100_000

#: Names that stand before an assigned secret, and prefixes of issued keys.
NAMES = ["token", "password", "passwd", "secret", "apikey", "api_key", "access_key", "auth", "credential", "private_key", "passphrase", "pwd"]
PREFIXES = ["AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "rk_live_", "xoxb-", "xoxp-", "npm_", "pypi-", "AIza"]
ISSUED = re.compile("(?:" + "|".join(map(re.escape, PREFIXES)) + ")[A-Za-z0-9_-]{12,}")
ASSIGNED = re.compile(
    "(?:" + "|".join(NAMES) + r")\\?[\"'`]?\]?\s*(?::=|=>|==?|:)\s*\\?[\"'`]?(?:(?:Bearer|Basic|Token|Digest)\s+)?$", re.I)
AFTER_BEARER = re.compile(r"(?<!\w)(?:[Bb]earer|BEARER)\s+$")
#: Numbers, dates, times, versions.
PLAIN = re.compile(r"[0-9][0-9_+/.,:\-]*")

FINDING = "value string, before string, after string, path string, label int"


def _named(text: str, end: int) -> bool:
    """Whether a name stands before ``end``."""
    head = text[max(0, end - NEAR):end].rstrip().rstrip("\"'`])\\")
    word = re.search(r"[\w.\-]*$", head).group()
    return bool(re.search(r"[^\W\d]", word)) and not word[0].isdigit()


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """(begin, end) of each assigned value. Inside another value only those of
    telling names count, so no character is in more than two."""
    plain_end = telling_end = 0
    for sign in SIGN.finditer(text):
        at = sign.end()
        if at < telling_end or not _named(text, sign.start()):
            continue
        telling = bool(ASSIGNED.search(text[max(0, sign.start() - NEAR):at]))
        if at < plain_end and not telling or not (m := VALUE.match(text, at)):
            continue
        a, b = m.span(m.lastindex)
        if telling:
            telling_end = b
        else:
            plain_end = b
        if text.startswith("//", a) or not any(map(str.isalnum, text[a:b])):
            continue
        if telling or b - a >= SHORT:
            yield a, b


def candidates(text: str) -> list[tuple[int, int]]:
    """(begin, end) of each candidate."""
    blocks = [m.span() for m in PEM.finditer(text)] if "-----BEGIN" in text else []
    inner = {m.span() for m in CANDIDATE.finditer(text) if m.end() - m.start() >= LEAST}
    if "eyJ" in text:
        tokens = [m.span() for m in JWT.finditer(text)]
        ends = np.array([b for _, b in tokens], dtype=np.int64)
        # Parts of a token are not judged on their own.
        at = lambda a: int(np.searchsorted(ends, a, "right"))
        inner = {s for s in inner if at(s[0]) == len(tokens) or tokens[at(s[0])][0] > s[0]} | set(tokens)
    inner.update(_assigned(text))
    inner.update(m.span(1) for m in BEARER.finditer(text))
    if blocks:
        ends = np.array([b for _, b in blocks])
        at = lambda a: int(np.searchsorted(ends, a, "right"))
        inner = {s for s in inner if at(s[0]) == len(blocks) or blocks[at(s[0])][0] > s[0]}
    return sorted(inner | set(blocks))


def _whole_format(value: str) -> bool:
    return bool(ISSUED.fullmatch(value) or JWT.fullmatch(value) or PEM.fullmatch(value))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _slot(word: str, salt: int) -> int:
    """Small stable hash of a neighbouring word."""
    h = salt
    for b in word.lower().encode()[:24]:
        h = (h * 31 + b) & 0xFFFFFFFF
    return (h * 2654435761 & 0xFFFFFFFF) >> 26


_WORD = re.compile(r"[^\W\d_]{2,}")
#: Words of a text that stand alone, not parts of longer strings.
_ALONE = re.compile(r"(?<![\w+/\-])[^\W\d_]{2,}(?![\w+/\-])")


def _code(word: str) -> int:
    return int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)


@dataclass
class Dictionary:
    """Set of words as sorted 64-bit hashes, 8 bytes a word."""

    codes: np.ndarray

    def __contains__(self, word: str) -> bool:
        code = _code(word)
        i = int(np.searchsorted(self.codes, code))
        return i < len(self.codes) and int(self.codes[i]) == code


@dataclass
class Lexicon:
    """Dictionary words and costs of character transitions."""

    words: Container[str]
    steps: np.ndarray

    @staticmethod
    def of(words: Container[str], steps: np.ndarray) -> Lexicon:
        """From transition counts."""
        return Lexicon(words, -np.log((steps + 1) / (steps + 1).sum(axis=1, keepdims=True)))

    def describe(self, value: str, before: str, after: str, path: str | None) -> list[float]:
        n = len(value)
        kinds = [_kind(c) for c in value]
        moves = np.zeros((4, 4))
        for a, b in zip(kinds, kinds[1:]):
            moves[a, b] += 1
        codes = [min(ord(c), 127) for c in value.lower()]
        surprise = float(np.mean([self.steps[a, b] for a, b in zip(codes, codes[1:])])) if n > 1 else 0.0
        low = value.lower()
        covered = sum(len(w) for w in _WORD.findall(low) if w in self.words)
        counts = np.bincount(codes)
        share = counts[counts > 0] / n
        left = _WORD.findall(before)
        right = _WORD.findall(after)
        near = before.rstrip("\"' ")
        return [
            n, surprise, float(-(share * np.log2(share)).sum()), len(set(low)), covered / n,
            *(kinds.count(k) / n for k in range(4)), *(moves.ravel() / max(1, n - 1)),
            float(_whole_format(value)), float(all(c in "0123456789abcdef" for c in low)), float(n == 16), n % 8,
            float(near.endswith("=")), float(near.endswith(":")), float(before[-1:] in ("\"", "'")),
            float(after[:1] in ("\"", "'")), float(bool(before) and not before[-1:].isspace()),
            _slot(left[-1], 1) if left else -1, float(bool(ASSIGNED.search(before))),
            float(bool(AFTER_BEARER.search(before))), value.count(" ") / n, float("." in value),
            float(bool(PLAIN.fullmatch(value))), float(any(map(str.isdigit, value))),
            _slot(right[0], 2) if right else -1, _slot(path or "", 3), float("/" in (path or "")),
        ]


@dataclass
class Forest:
    """Trees as arrays: feature (-1 at a leaf), threshold, left child (right follows), share of secrets."""

    lexicon: Lexicon
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def share(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, limit, child, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while (open_ := np.flatnonzero(feature[at] >= 0)).size:
                node = at[open_]
                at[open_] = child[node] + (x[open_, feature[node]] > limit[node])
            total += value[at]
        return total / max(1, len(self.trees))

    def secrets(self, text: str, path: str | None, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        if not spans or not self.trees:
            return []
        x = np.array([self.lexicon.describe(text[a:b], text[max(0, a - NEAR):a], text[b:b + NEAR], path) for a, b in spans])
        out: list[tuple[int, int]] = []
        for (a, b), p in sorted(zip(spans, self.share(x))):
            if p >= 0.5 and out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            elif p >= 0.5:
                out.append((a, b))
        return out


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple:
    """One tree on a bootstrap sample, with a random subset of features per node."""
    pick = rng.integers(0, len(x), len(x))
    x, y = x[pick], y[pick]
    feature, limit, child, value = [], [], [], []
    todo = [(np.arange(len(x)), 0)]
    for rows, depth in todo:
        own = y[rows]
        feature.append(-1), limit.append(0.0), child.append(-1), value.append(float(own.mean()))
        if depth == DEPTH or len(rows) < 2 * LEAF or own.min() == own.max():
            continue
        best = (1e-9, -1, 0.0)
        for j in rng.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1])) + 1), replace=False):
            order = np.argsort(x[rows, j], kind="stable")
            v, s = x[rows[order], j], np.cumsum(own[order])
            n = np.arange(1, len(rows) + 1)
            # Drop in squared error of a cut behind each row.
            gain = s[:-1] ** 2 / n[:-1] + (s[-1] - s[:-1]) ** 2 / (n[-1] - n[:-1]) - s[-1] ** 2 / n[-1]
            gain[(v[1:] == v[:-1]) | (n[:-1] < LEAF) | (n[-1] - n[:-1] < LEAF)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                # The lower value itself: the middle of two neighbouring floats may be the upper one.
                best = (float(gain[k]), int(j), float(v[k]))
        if best[1] < 0:
            continue
        at = len(feature) - 1
        feature[at], limit[at], child[at] = best[1], best[2], len(todo)
        over = x[rows, best[1]] > best[2]
        todo += [(rows[~over], depth + 1), (rows[over], depth + 1)]
    return np.array(feature), np.array(limit), np.array(child), np.array(value)


_UPPER, _MIXED, _HEX = (list(x) for x in (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef"))
_PLACES = [("it was the end of ", " and then it went on"), ("", ""), ("see (", ") for more"), ("\n", "\n"), ("they had, in all, ", ".")]
_ORDINARY = "river window letter garden summer yellow quiet number market silver forest simple report table winter morning".split()


def _issued_examples(findings: list[tuple]) -> list[tuple]:
    """Examples of secrets whose format a corpus may hardly show. Issued formats
    stand in the place of ordinary numbers, so only the value tells them apart."""
    rng = np.random.default_rng(11)
    some = lambda of, n: "".join(rng.choice(of, n))
    places = ([f[1:4] for f in findings if f[4] == 0 and PLAIN.fullmatch(f[0])][:EXAMPLES] or [(*p, None) for p in _PLACES])
    out = []
    for i in range(EXAMPLES):
        before, after, path = places[i % len(places)]
        prefix = PREFIXES[i % len(PREFIXES)]
        tail = some(_UPPER, 15) if prefix.isupper() else some(_MIXED, int(rng.integers(19, 36)))
        out.append((prefix + tail + str(i % 10), before, after, path, 1))
        if i % 3 == 0:
            out.append((".".join(["eyJ" + some(_MIXED, 17), "eyJ" + some(_MIXED, 20 + i), some(_MIXED, 43)]), before, after, path, 1))
            kind = ("RSA ", "", "EC ", "OPENSSH ")[i % 4] + "PRIVATE KEY-----"
            body = "\n".join(some(_MIXED, 64) for _ in range(1 + i % 26))
            out.append((f"-----BEGIN {kind}\n{body}\n-----END {kind}", before, after, path, 1))
        bearer = ("Authorization: Bearer ", "sent with Bearer ", "-H 'Authorization: bearer ")[i % 3]
        out.append((some(_MIXED, int(rng.integers(16, 60))), bearer, "\n" if i % 3 else "' ", path, 1))
        words = [str(w) for w in rng.choice(_ORDINARY, 3)]
        value = ("-".join(words), " ".join(words), some(_MIXED, 6) + "!", some(_MIXED, 7), words[0] + "&3" + words[1] + "!aa",
                 some(_HEX, 32), words[0], some(_MIXED, 24) + "==")[i % 8]
        name = NAMES[i // 8 % len(NAMES)]
        for sign in (' = "', ": '", "="):
            if sign != "=" or " " not in value and value != words[0]:
                out.append((value, f"{before[-12:]} {name}{sign}", {"=": "\n"}.get(sign, sign[-1] + after[:12]), path, 1))
    return out


def _ordinary_examples() -> list[tuple]:
    """Examples of what is no secret: numbers, and values of names that tell nothing."""
    rng = np.random.default_rng(12)
    out = []
    for i in range(2 * EXAMPLES):
        number = str(int(rng.integers(10 ** 7, 10 ** 16)))
        words = [str(w) for w in rng.choice(_ORDINARY, 3)]
        before, after = _PLACES[i % len(_PLACES)]
        if i % 4 == 0:
            out.append(("".join(rng.choice(_HEX, (40, 32, 64)[i % 3])), before + ("commit ", "revision ", "checksum ", "sha256 ")[i // 4 % 4], after, None, 0))
        out.append(((number, f"20{i % 30:02d}-0{1 + i % 9}-1{i % 10}", words[0] + "-" + number[:3], words[0] + "_" + words[1] + number[:1])[i % 4],
                    before, after, None, 0))
        name = ("title", "name", "color", "mode", "note", "path", "label", "level")[i // 5 % 8]
        sign = (' = "', ": '", "=", ": ")[i % 4]
        value = ("-".join(words), " ".join(words), words[0], words[0] + "_" + words[1], number)[i % 5]
        if i % 4 > 1:
            value = value.split(" ")[0]
        out.append((value, f"{before[-12:]} {name}{sign}", sign[-1] + after if i % 4 < 2 else " " + after, None, 0))
    return out


def _add_steps(steps: np.ndarray, word: str, times: int) -> None:
    codes = [min(ord(c), 127) for c in word]
    for a, b in zip(codes, codes[1:]):
        steps[a, b] += times


def word_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): in how many documents each lower-case word stands, over all
    documents. Tasks send sums of at most ``HELD`` words at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for t in batch["text"].to_pylist():
                if t:
                    held.update(set(_ALONE.findall(t.lower())))
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    parts = small_batches(documents).select(F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return staged(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")


def lexicon_of(words: DataFrame, rows: int) -> Lexicon:
    """Lexicon of a (word, n) table over ``rows`` documents. A dictionary word
    stands in two documents at least and in one of every ``RARE``; transitions
    count all words."""
    least = max(2, -(-rows // RARE))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(map(_code, batch["word"].to_pylist())), pa.int64())], names=["code"])

    known = words.where((F.col("n") >= least) & (F.length("word") > 2)).select("word").mapInArrow(coded, "code long")
    known = Dictionary(np.sort(known.toArrow()["code"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.zeros((128, 128), dtype=np.int64)
        for batch in batches:
            for w, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist()):
                _add_steps(steps, w, n)
        at = np.flatnonzero(steps)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(steps.ravel()[at])], names=["at", "n"])

    steps = np.zeros(128 * 128)
    for r in words.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        steps[r["at"]] = r["n"]
    return Lexicon.of(known, steps.reshape(128, 128))


def corpus_lexicon(documents: DataFrame, text: str = "text") -> Lexicon:
    """Lexicon counted over all ``documents``."""
    return lexicon_of(word_counts(documents, text), documents.count())


def _near_lexicon(findings: list[tuple]) -> Lexicon:
    """Lexicon of the findings' neighbourhoods, for findings that come without documents."""
    steps = np.zeros((128, 128))
    words: Counter[str] = Counter()
    for _, before, after, _, _ in findings:
        for w in _WORD.findall(f"{before} {after}".lower()):
            words[w] += 1
            _add_steps(steps, w, 1)
    return Lexicon.of(frozenset(w for w, n in words.items() if n > 1 and len(w) > 2), steps)


def fit_rows(findings: list[tuple[str, str, str, str | None, int]], lexicon: Lexicon | None = None) -> Forest:
    """The forest of (value, before, after, path, label) rows."""
    findings = findings + _issued_examples(findings) + _ordinary_examples()
    lexicon = lexicon or _near_lexicon(findings)
    y = np.array([f[4] for f in findings], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Forest(lexicon, [])
    x = np.array([lexicon.describe(*f[:4]) for f in findings])
    rng = np.random.default_rng(7)
    return Forest(lexicon, [_grow(x, y, rng) for _ in range(TREES)])


def _label(lexicon: Lexicon, value: str, before: str) -> int | None:
    """1 for a secret, 0 for none, None if the format does not tell."""
    if _whole_format(value):
        return 1
    ordinary = bool(PLAIN.fullmatch(value)) or _is_words(lexicon, value)
    if ASSIGNED.search(before):
        # A quoted word may be a password; numbers and bare words may be anything.
        return 1 if not ordinary or not value[0].isdigit() and before[-1:] in ("\"", "'", "`") else None
    return 0 if ordinary and not AFTER_BEARER.search(before) else None


def _is_words(lexicon: Lexicon, value: str) -> bool:
    """Dictionary words, perhaps with a short number or punctuation."""
    words = [w for w in _WORD.findall(value.lower()) if len(w) > 2]
    return bool(words) and sum(map(str.isdigit, value)) <= 4 and all(w in lexicon.words for w in words)


def weak_findings(documents: DataFrame, text: str = "text", path: str = "source", max_rows: int = MAX_ROWS,
                  lexicon: Lexicon | None = None) -> DataFrame:
    """Labelled findings by format rules: whole keys of an issued format, and values
    assigned to a telling name, are secrets (1); plain numbers and dictionary words
    are not (0); all else stays unlabelled, so that the forest decides on it."""
    lexicon = lexicon or corpus_lexicon(documents, text)
    source = F.col(path).cast("string") if path in documents.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, path in zip(batch["text"].to_pylist(), batch["path"].to_pylist()):
                for a, b in candidates(text) if text else ():
                    value, before, after = text[a:b], text[max(0, a - NEAR):a], text[b:b + NEAR]
                    label = _label(lexicon, value, before)
                    if label is not None:
                        rows.append((value, before, after, path, label))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.string()) for c in cols[:4]), pa.array(cols[4], pa.int32())],
                names=["value", "before", "after", "path", "label"])

    found = small_batches(documents).select(F.col(text).alias("text"), source.alias("path")).mapInArrow(run, FINDING)
    # Half of the sample for each label, so that rare secrets are not lost among other numbers.
    order = [F.xxhash64("value", "before"), "value", "before", "after", F.col("path").asc_nulls_first()]
    half = lambda k: found.where(F.col("label") == k).orderBy(*order).limit(max_rows // 2)
    return half(1).unionByName(half(0))


def fit(findings: DataFrame, max_rows: int = MAX_ROWS, lexicon: Lexicon | None = None) -> Forest:
    """Train on at most ``max_rows`` findings, chosen by hash; rows without value or
    label are skipped. ``lexicon`` is that of the corpus."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = (
        findings.where(F.col("value").isNotNull() & F.col("label").isin(0, 1))
        .select("value", text("before"), text("after"), "path", "label")
        .orderBy(F.xxhash64("value", "before"), "value", "before", "after", F.col("path").asc_nulls_first(), "label")
        .limit(max_rows).collect())
    return fit_rows([tuple(r) for r in rows], lexicon)


def fit_corpus(documents: DataFrame) -> Forest:
    """The forest of weak findings, with dictionary and transitions of all documents."""
    lexicon = corpus_lexicon(documents)
    return fit(weak_findings(documents, lexicon=lexicon), lexicon=lexicon)


def scanned(documents: DataFrame, forest: Forest, text: str = "text", path: str = "source") -> DataFrame:
    """``documents`` with ``n_candidates``, ``secrets`` (spans in code points) and
    ``redacted``; columns of these names are replaced. One pass, no shuffle."""
    base = documents.drop("n_candidates", "secrets", "redacted")
    span = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([
        *base.schema.fields, T.StructField("n_candidates", T.IntegerType()), T.StructField("secrets", span),
        T.StructField("redacted", T.StringType())])
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    has_path = path in base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch[text].to_pylist()
            paths = batch[path].cast(pa.string()).to_pylist() if has_path else [None] * len(texts)
            many, found, clean = [], [], []
            for t, p in zip(texts, paths):
                all_spans = candidates(t) if t else []
                spans = forest.secrets(t, p, all_spans)
                many.append(len(all_spans))
                found.append([{"begin": a, "end": b} for a, b in spans])
                if spans:
                    ends = [0, *(b for _, b in spans)]
                    t = MASK.join([*(t[e:a] for e, (a, _) in zip(ends, spans)), t[ends[-1]:]])
                clean.append(t)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(many, pa.int32()), pa.array(found, kind), pa.array(clean, pa.string())],
                names=schema.names)

    return small_batches(base).mapInArrow(run, schema)


def digest(documents: DataFrame) -> DataFrame:
    """Findings and the redacted text's checksum per document."""
    forest = fit_corpus(documents)
    return scanned(documents.select("doc_id", "source", "text"), forest).select(
        "doc_id", "n_candidates", F.size("secrets").alias("n_secrets"), "secrets",
        F.sha2(F.coalesce("redacted", F.lit("")), 256).alias("redacted_sha256"))


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with secrets in ``text`` masked; no row goes."""
    forest = fit_corpus(documents)
    return scanned(documents, forest).select(
        *[F.col("redacted").alias(c) if c == "text" else c for c in documents.columns])
