"""Secrets: fixed patterns, and a linear-chain conditional random field that adds spans.

Tokens are tagged begin, inside or outside. Features are a token's shape, the words around it and a few
properties of the whole text. The field is trained on a bounded sample of documents whose tags come from
the patterns, and generalises over shape and context. Decoding is Viterbi over whole texts: a
token whose own scores put "outside" so far ahead that no transition can make up for it is outside on
every best path, so the recursion only runs over the stretches between such tokens.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.shared import row_hash, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The patterns, their kinds in the order in which equal starts are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
# Texts that may hold a base span, for the choice of training documents.
HINT = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[a-z0-9+/_.=-]{6}"
        r"|AKIA[A-Z0-9]{16}|[0-9a-f]{24}")

# Runs of word characters and +/.- that do not end in a stop or hyphen, and single other characters.
TOKEN = re.compile(r"[\w+/](?:[\w+/.\-]*[\w+/])?|\S")
BEGIN, INSIDE, OUTSIDE = range(3)
BITS = 13
MAX_DOCUMENTS = 1000  # with a base span; as many without
MAX_CHARS = 100_000   # longest text to train on, as the sample goes to the driver
WINDOW = 24           # tokens on either side of a training span, and of a drawn stretch less one
MEMO = 1_000_000
BLOCK = 1 << 16
# Offsets of the neighbours whose words and shapes are features.
AROUND = (-1, -2, -3, 1)
# What stands before secrets whose cue is hidden.
PLAIN_WORDS = "entry item field line note value".split()
PHRASES = ["client key is", "Authorization: Bearer", "signing key:", "auth header", "private key =", "credential is",
           "session id:", "license key is"]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
KNOWN = 5
WIDTH = 8 + 2 * len(AROUND) + 4  # most features of a token: its own, its neighbours', the text's


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, in the order of start and kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def shape(token: str) -> str:
    """Character classes with runs shortened, at most eight of them."""
    classes = re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", token[:64])
    return re.sub(r"(.)\1+", r"\1", re.sub(r"\d", "0", classes))[:8]


def kind_of(token: str) -> tuple:
    """What a token's features depend on, besides its word: for plain words only case and length. A word of
    letters in one case, or with a capital first, is plain however long."""
    n = len(token)
    if token.isalpha() and (n < 16 or token.islower() or token.isupper() or token.istitle()):
        case = "a" if token.islower() else "A" if token.isupper() else "Aa" if token.istitle() else "aA"
        return case, n.bit_length()
    head = token[:64]
    digits, uppers = sum(map(str.isdigit, head)), sum(map(str.isupper, head))
    return (shape(token), f"{min(n, 48).bit_length()}:{n >= 20}:{n >= 32}", token[:4],
            f"{n >= 16}:{not token.strip('0123456789abcdef')}:{not token.strip('0123456789ABCDEF')}",
            f"{4 * digits // len(head)}:{n >= 12}",
            f"{digits > 2}:{uppers > 2}:{len(head) - digits > 2}:{n >= 16}",
            f"{8 * len(set(head)) // len(head)}:{n >= 16}")


def bucket(feature: str) -> int:
    return crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def own_features(kind: tuple) -> list[int]:
    return [bucket(f"o{len(kind)}{i}:{part}") for i, part in enumerate(kind)] + [bucket("bias")]


def word_of(token: str) -> str:
    return token[:16].lower()


def near_features(kind: tuple, word: str | None, at: int) -> list[int]:
    """Features of the token at distance ``-at``: the kind, and the word if it is a known one."""
    return [bucket(f"t{at}:{kind[0]}")] + ([bucket(f"w{at}:{word}")] if word is not None else [])


def file_features(text: str) -> list[int]:
    """Properties of the whole text: shares of digits, symbols and line ends, size."""
    n = max(1, len(text))
    digits = sum(map(text.count, "0123456789"))
    symbols = sum(map(text.count, "={}\"';:"))
    return [bucket(f) for f in (f"fd:{int(100 * digits / n).bit_length()}",
                                f"fs:{int(100 * symbols / n).bit_length()}",
                                f"fl:{int(1000 * text.count(chr(10)) / n).bit_length()}",
                                f"fn:{n.bit_length() // 2}")]


@dataclass
class Field:
    """Weights (features x tags), transitions (from tag x to tag), and the words that count as known
    in a neighbour: those that occurred several times around the training spans."""

    weights: np.ndarray
    moves: np.ndarray
    words: frozenset

    def margin(self) -> float:
        """By how much transitions can at most favour another tag over outside at one token."""
        into = (self.moves - self.moves[:, [OUTSIDE]]).max()
        out = (self.moves - self.moves[[OUTSIDE], :]).max()
        return float(max(0.0, into) + max(0.0, out))


class Tagger:
    """Tags of texts. Scores of a token and what it adds to its neighbours' are kept per kind of
    token, and the kind of up to ``MEMO`` distinct tokens."""

    def __init__(self, field: Field):
        self.field, self.limit = field, field.margin()
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.kinds: dict[tuple, int] = {}
        self.table = np.zeros((1024, 3 * (1 + len(AROUND))), np.float32)

    def add(self, token: str) -> None:
        word = word_of(token)
        key = kind_of(token), word if word in self.field.words else None
        row = self.kinds.get(key)
        if row is None:
            row = self.kinds[key] = len(self.kinds)
            if row == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            weights = self.field.weights
            self.table[row] = np.concatenate([weights[own_features(key[0])].sum(axis=0)] + [
                weights[near_features(*key, at)].sum(axis=0) for at in AROUND])
        self.place[token] = row

    def rows(self, tokens: list[str]) -> np.ndarray:
        if len(self.place) > MEMO:
            self.forget()
        ids = list(map(self.place.get, tokens))
        if None in ids:
            for token, row in zip(tokens, ids):
                if row is None and token not in self.place:
                    self.add(token)
            ids = list(map(self.place.__getitem__, tokens))
        return np.array(ids)

    def scores(self, ids: np.ndarray, start: int, stop: int, whole: np.ndarray) -> np.ndarray:
        """Scores (tokens x tags) of the tokens from ``start`` to ``stop``."""
        out = self.table[ids[start:stop], :3] + whole
        for k, at in enumerate(AROUND, 1):
            lo, hi = max(start, -at), min(stop, len(ids) - at)
            if lo < hi:
                out[lo - start:hi - start] += self.table[ids[lo + at:hi + at], 3 * k:3 * k + 3]
        return out

    def tag(self, tokens: list[str], text: str) -> dict[int, int]:
        """The tokens that are not outside on the best path, with their tags."""
        if not tokens:
            return {}
        ids, whole = self.rows(tokens), self.field.weights[file_features(text)].sum(axis=0)
        unsure: dict[int, np.ndarray] = {}
        for start in range(0, len(ids), BLOCK):
            scores = self.scores(ids, start, min(len(ids), start + BLOCK), whole)
            behind = np.flatnonzero(scores[:, OUTSIDE] - scores[:, :OUTSIDE].max(axis=1) <= self.limit)
            unsure.update(zip((behind + start).tolist(), scores[behind]))
        tags, stretch = {}, []
        for i in [*unsure, None]:
            if stretch and (i is None or i > stretch[-1] + 1):
                best = viterbi(np.stack([unsure[j] for j in stretch]), self.field.moves,
                               first=OUTSIDE if stretch[0] else None,
                               last=OUTSIDE if stretch[-1] + 1 < len(tokens) else None)
                tags.update((j, t) for j, t in zip(stretch, best) if t != OUTSIDE)
                stretch = []
            stretch.append(i)
        return tags


def viterbi(scores: np.ndarray, moves: np.ndarray, first: int | None, last: int | None) -> list[int]:
    """The best tags, behind a token tagged ``first`` and before one tagged ``last`` where given."""
    best = scores[0] + (moves[first] if first is not None else 0)
    back = []
    for row in scores[1:]:
        paths = best[:, None] + moves
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    tag = int((best + (moves[:, last] if last is not None else 0)).argmax())
    tags = [tag]
    for step in reversed(back):
        tag = int(step[tag])
        tags.append(tag)
    return tags[::-1]


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text)]


def secret_values(text: str) -> list[tuple[int, int]]:
    """Where the patterns' secrets are; of an assignment, only the value is the secret."""
    values = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return sorted(values + [(s, e) for s, kind, e in base_spans(text) if kind])


def made_up(seed: int) -> str:
    """A value unlike the patterns': letters of both cases and digits, some with the signs of base64 or hyphens."""
    signs = LETTERS + ("", "+/", "-_")[seed % 3]
    size, state, out = 24 + seed // 3 % 25, seed, []
    for _ in range(size):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(signs[(state >> 33) % len(signs)])
    return "".join(out) + "=" * (seed // 75 % 3 if seed % 3 == 1 else 0)


def disguised(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The text with the cues of half its secrets hidden, and where the secrets are then.

    Which and how, a hash decides: the key word gives way to a plain one, or the value to a made-up one behind a
    phrase that the patterns do not know, or to a made-up one with no cue at all. So the field learns from shape and
    neighbours what the patterns know by heart.
    """
    keys = {m.span(2): m.start() for m in ASSIGN.finditer(text)}
    out, values, upto, size = [], [], 0, 0

    def put(part: str) -> None:
        nonlocal size
        out.append(part)
        size += len(part)

    for start, end in secret_values(text):
        begin = keys.get((start, end), start)
        if begin < upto:
            continue
        draw = crc32(f"{begin}:{text[begin:end]}".encode("utf-8", "surrogatepass"))
        put(text[upto:begin])
        way, seed = draw % 6, draw // 6
        cue, value = text[begin:start], text[start:end]
        if way == 3:
            cue = f"{PLAIN_WORDS[seed % len(PLAIN_WORDS)]} = " if begin < start else ""
        elif way > 3:
            cue, value = (f"{PHRASES[seed % len(PHRASES)]} " if way == 4 else ""), made_up(seed)
        put(cue)
        values.append((size, size + len(value)))
        put(value)
        upto = end
    put(text[upto:])
    return "".join(out), values


def planted(text: str) -> tuple[str, list[tuple[int, int]]]:
    """A text without secrets, with a made-up one put into every other such text, behind a phrase or none, at a
    blank that a hash draws. So a text's own properties do not tell whether it holds one."""
    draw = crc32(text.encode("utf-8", "surrogatepass"))
    blanks = [m.start() for m in re.finditer(r"\s", text)]
    if draw % 2 or not blanks:
        return text, []
    seed = draw // 2
    at = blanks[seed % len(blanks)] + 1
    cue, value = f"{PHRASES[seed // 7 % len(PHRASES)]} " if seed % 3 else "", made_up(seed)
    return f"{text[:at]}{cue}{value} {text[at:]}", [(at + len(cue), at + len(cue) + len(value))]


def silver_tags(values: list[tuple[int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
    """Tags of tokens from the places of secrets."""
    tags = np.full(len(spans), OUTSIDE)
    begins = np.array([s for s, _ in spans] or [0])
    for s, e in sorted(values):
        i = int(np.searchsorted(begins, s, "right")) - 1
        inside = False
        for j in range(max(i, 0), len(spans)):
            if spans[j][0] >= e:
                break
            if spans[j][1] > s:
                tags[j] = INSIDE if inside else BEGIN
                inside = True
    return tags


def examples(texts: list[str], window: int = WINDOW) -> tuple[list[tuple[np.ndarray, np.ndarray]], frozenset]:
    """(features, tags) of stretches of tokens, and the known words. Stretches are the tokens up to
    ``window`` away from tagged ones and, in every text, ``window + 1`` at a place drawn by its hash, so
    that all parts of texts count. ``features`` is tokens x features, -1 where there is none."""
    stretches, seen = [], Counter()
    for text in texts:
        text, values = disguised(text) if secret_values(text) else planted(text)
        spans = tokens_of(text)
        words, tags = [text[s:e] for s, e in spans], silver_tags(values, spans)
        marked = np.flatnonzero(tags != OUTSIDE)
        near = np.zeros(len(words), bool)
        for i in marked:
            near[max(0, i - window):i + window + 1] = True
        drawn = crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(words) - window)
        near[drawn:drawn + window + 1] = True
        for i in marked:
            seen.update({word_of(words[i + at]) for at in AROUND if 0 <= i + at < len(words)})
        edges = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]])))
        for start, stop in edges.reshape(-1, 2):
            for at in range(start, stop, 4 * window):
                stretches.append((text, words, tags, at, min(stop, at + 4 * window)))
    known = frozenset(word for word, n in seen.items() if n >= KNOWN)
    out = []
    for text, words, tags, start, end in stretches:
        lo, hi, whole = max(0, start - 3), min(len(words), end + 3), file_features(text)
        kinds = [kind_of(w) for w in words[lo:hi]]
        names = [word_of(w) if word_of(w) in known else None for w in words[lo:hi]]
        rows = np.full((end - start, WIDTH), -1)
        for i in range(start, end):
            found = own_features(kinds[i - lo])
            for at in AROUND:
                if 0 <= i + at < len(words):
                    found += near_features(kinds[i + at - lo], names[i + at - lo], at)
            rows[i - start, :len(found) + len(whole)] = found + whole
        out.append((rows, tags[start:end]))
    return out, known


def train(data: list[tuple[np.ndarray, np.ndarray]], known: frozenset, rounds: int = 60, rate: float = 0.15,
          penalty: float = 2e-4) -> Field:
    """Maximises the penalised conditional likelihood of the tags by full-batch Adam, with gradients from
    the forward-backward recursion over all stretches at once. Deterministic. Without examples every
    token is outside."""
    weights, moves = np.zeros((1 << BITS, 3)), np.zeros((3, 3))
    if not data:
        weights[bucket("bias"), OUTSIDE] = 10.0
        return Field(weights.astype(np.float32), moves.astype(np.float32), known)
    size, longest = len(data), max(len(t) for _, t in data)
    feats = np.full((longest, size, WIDTH), -1)
    tags, mask = np.full((longest, size), OUTSIDE), np.zeros((longest, size), bool)
    for k, (rows, mine) in enumerate(data):
        feats[:len(mine), k], tags[:len(mine), k], mask[:len(mine), k] = rows, mine, True
    used, where = feats[mask], np.eye(3)[tags] * mask[:, :, None]
    has = used >= 0
    flat = np.where(has, used, 0)
    # Token and feature of every use, by feature: sums over the uses of a feature are stretches.
    order = np.argsort(used[has], kind="stable")
    at_token, by_feature = np.nonzero(has)[0][order], used[has][order]
    starts = np.flatnonzero(np.diff(by_feature, prepend=-1))
    seen = np.zeros((3, 3))
    both = mask[1:] & mask[:-1]
    np.add.at(seen, (tags[:-1][both], tags[1:][both]), 1)
    first, second = [np.zeros_like(x) for x in (weights, moves)], [np.zeros_like(x) for x in (weights, moves)]
    total = mask.sum()

    def normal(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, rounds + 1):
        scores = np.zeros((longest, size, 3))
        scores[mask] = (weights[flat] * has[:, :, None]).sum(axis=1)
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, longest):
            new = normal(ahead[t - 1][:, :, None] + moves, 1) + scores[t]
            ahead[t] = np.where(mask[t][:, None], new, ahead[t - 1])
        for t in range(longest - 2, -1, -1):
            new = normal(moves + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
            behind[t] = np.where(mask[t + 1][:, None], new, 0.0)
        norm = normal(ahead[-1], 1)
        chance = np.exp(ahead + behind - norm[None, :, None]) * mask[:, :, None]
        pair = np.exp(ahead[:-1, :, :, None] + moves + (scores[1:] + behind[1:])[:, :, None, :]
                      - norm[None, :, None, None]) * both[:, :, None, None]
        slope = np.zeros_like(weights)
        slope[by_feature[starts]] = np.add.reduceat((where - chance)[mask][at_token], starts, axis=0)
        slopes = [slope / total - penalty * weights, (seen - pair.sum(axis=(0, 1))) / total - penalty * moves]
        for i, (value, grad) in enumerate(zip((weights, moves), slopes)):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad * grad
            value += rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    return Field(weights.astype(np.float32), moves.astype(np.float32), known)


def training_texts(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> list[str]:
    """The texts of at most ``max_documents`` documents that may hold a base span and as many that do
    not, the first by a hash of the id, none longer than ``MAX_CHARS``. The ids are found first, so that
    no text is sorted."""
    rows = docs.where("text is not null and doc_id is not null").where(F.length("text") <= MAX_CHARS).select(
        "doc_id", F.col("text").cast("string").alias("text"), row_hash().alias("hash"))
    order = [F.xxhash64(F.lit(5), "doc_id"), F.col("doc_id"), F.col("hash")]
    flagged = written(rows.select("doc_id", "hash", F.col("text").rlike(HINT).alias("hint")), "hints")
    first = [flagged.where(F.col("hint") == hint).select("doc_id", "hash").distinct().orderBy(*order)
             .limit(max_documents) for hint in (True, False)]
    few = F.broadcast(written(first[0].union(first[1]), "training-rows"))
    # One of the rows that repeat both id and text, so there are at most as many as were chosen.
    found = rows.join(few, ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"]).collect()
    return [r["text"] for r in sorted(found, key=lambda r: (r["doc_id"], r["text"]))]


def fit(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, window: int = WINDOW) -> Field:
    return train(*examples(training_texts(docs, max_documents), window))


def crf_spans(text: str, tagger: Tagger, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The field's spans that do not touch a base span: from a begin (or an inside behind an
    outside) over the insides that follow."""
    words = TOKEN.findall(text)
    tags = tagger.tag(words, text)
    if not tags:
        return []
    spans, out = tokens_of(text), []
    for i, tag in tags.items():
        if tag == INSIDE and i - 1 in tags:
            out[-1][2] = spans[i][1]
        else:
            out.append([spans[i][0], 3, spans[i][1]])
    return [tuple(s) for s in out if not any(b[0] < s[2] and s[0] < b[2] for b in base)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{s}:{e}" for s, kind, e in spans)


def find_secrets(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans for every row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, by start and kind. Null and empty texts
    have none. Repeated rows and null ids are scanned like any other; an empty table gives no rows.
    """
    # Plain values: a broadcast object would be unpickled by the name of its module.
    sent = docs.sparkSession.sparkContext.broadcast((field.weights, field.moves, sorted(field.words)))

    @F.pandas_udf("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,n_crf:bigint,"
                  "base_sha256:string,spans:string>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, moves, known = sent.value
        tagger = Tagger(Field(weights, moves, frozenset(known)))
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                base = base_spans(text)
                added = crf_spans(text, tagger, base)
                kinds = [kind for _, kind, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), len(added),
                             sha256(joined(base).encode()).hexdigest(), joined(sorted(base + added))))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_crf", "base_sha256",
                                              "spans"])

    return (docs.select("doc_id", scan.asNondeterministic()(F.col("text").cast("string")).alias("s"))
            .select("doc_id", "s.*"))
