"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens: a word's tokenization is the one path whose labels
spell the word. It starts as one state with an arc to itself for each letter.
The merge gadget of a rule (a, b) -> ab takes the state q that a leads to,
makes q' a copy of q without the arc b, lets a lead to q' and gives every
state that has an arc a an arc ab too, to where b leads. All arcs of a label
lead to one state, so a state is kept as its parent, the label that it lost
and the rule's number, and the arcs follow from these tables (Berglund,
Martens and van der Merwe, "Constructing a BPE Tokenization DFA").

A text is cut at spaces and line feeds into parts; a part's special tokens
are taken out, the rest is normalised and pre-split into words as the
tokenizer file says, and each new word is walked through the automaton once
per worker. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from kinrank.llm.common import pack, table
from kinrank.llm.packing import byte_letters

KEPT = 300_000        # parts whose tokens a worker keeps (twice so many at most)
LONGEST = 48          # letters of a part that is kept, at most
SEGMENT = 1 << 20     # characters of a long text handled at a time
SETTLED = "\u0370"    # below, letters have not changed between Unicode versions
LAST = "</w>"


class Automaton:
    """Token automaton of a list of merge rules over ``letters``."""

    def __init__(self, letters: list[str], merges: list[tuple[str, str]]):
        useful = merges
        while True:
            self._build(letters, useful)
            blocked = {i for i, (q, b) in enumerate(self._uses) if not self._has(q, b, i)}
            if not blocked:
                break
            useful = [m for i, m in enumerate(useful) if i not in blocked]
        self._known: dict[tuple[int, int], bool] = {}
        # longest label by its first four letters: where to begin a search
        self.reach: dict[str, int] = {}
        for t in self.ids:
            k = t.removesuffix(LAST) if len(t) > len(LAST) else t
            self.reach[k[:4]] = max(self.reach.get(k[:4], 0), len(k))

    def _build(self, letters: list[str], merges: list[tuple[str, str]]) -> None:
        self.ids = {t: i for i, t in enumerate(letters)}
        self.left: list[tuple[int, int] | None] = [None] * len(letters)  # (left part, rule) of each label
        self.to = [0] * len(letters)
        parent, lost, rule = [-1], [-1], [-1]
        self._uses: list[tuple[int, int]] = []
        for r, (a, b) in enumerate(merges):
            i, j = self.ids[a], self.ids[b]
            q, end = self.to[i], self.to[j]
            parent.append(q)
            lost.append(j)
            rule.append(r)
            self.to[i] = len(parent) - 1
            self._uses.append((q, j))
            if a + b not in self.ids:
                self.ids[a + b] = len(self.to)
                self.to.append(end)
                self.left.append((i, r))
        # Preorder numbers: a state's descendants are a range of them.
        below: list[list[int]] = [[] for _ in parent]
        for s in range(1, len(parent)):
            below[parent[s]].append(s)
        self.first, self.last = [0] * len(parent), [0] * len(parent)
        n, stack = 0, [(0, 0)]
        while stack:
            s, k = stack.pop()
            if not k:
                self.first[s] = n
                n += 1
            if k < len(below[s]):
                stack.append((s, k + 1))
                stack.append((below[s][k], 0))
            else:
                self.last[s] = n - 1
        # For each label: the ranges of states below the ones that lost it.
        self.lost: dict[int, tuple[list[int], list[int], list[int]]] = {}
        for s in sorted(range(1, len(parent)), key=self.first.__getitem__):
            starts, ends, rules = self.lost.setdefault(lost[s], ([], [], []))
            starts.append(self.first[s])
            ends.append(self.last[s])
            rules.append(rule[s])

    def _has(self, state: int, label: int, before: float = float("inf")) -> bool:
        """Whether the state has (had, before that rule) an arc with the label:
        neither the label nor, when its rule came, its left part was lost."""
        at, bound = self.first[state], before - 1
        x: int | None = label
        while x is not None:
            if x in self.lost:
                starts, ends, rules = self.lost[x]
                k = bisect_right(starts, at) - 1
                if k >= 0 and ends[k] >= at and rules[k] <= bound:
                    return False
            made = self.left[x]
            if made is None:
                return True
            x, bound = made
        return True

    def step(self, label: int, then: int) -> bool:
        """Whether ``then`` may follow ``label``."""
        key = (label, then)
        ok = self._known.get(key)
        if ok is None:
            if len(self._known) > 4 * KEPT:
                self._known.clear()
            ok = self._known[key] = self._has(self.to[label], then)
        return ok

    def walk(self, word: str, last: str = LAST) -> list[int]:
        """Labels of the path that spells the word. Long arcs are tried first;
        a prefix has one path only, so no place is reached twice."""
        ids, reach, n = self.ids, self.reach, len(word)
        path: list[tuple[int, int]] = []     # (label, where it starts)
        at, size = 0, min(reach.get(word[:4], 3), n)
        while True:
            while size:
                end = at + size
                t = ids.get(word[at:end] + last if end == n else word[at:end])
                if t is not None and (not path or self.step(path[-1][0], t)):
                    break
                size -= 1
            if size:
                path.append((t, at))
                at += size
                if at == n:
                    return [t for t, _ in path]
                size = min(reach.get(word[at:at + 4], 3), n - at)
            else:
                if not path:
                    raise ValueError(f"no path for {word!r}")
                _, start = path.pop()
                at, size = start, at - start - 1


class Recent:
    """Mapping that keeps what was used last: two generations of ``size``."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        got = self.new.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Bpe:
    """Encoder and decoder of a tokenizer file with words ending in ``</w>``."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, kinds = spec["model"]["vocab"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["end_of_word_suffix"] != LAST
                or split["behavior"] != "Removed" or not split["invert"] or spec["decoder"] is not None):
            raise ValueError(f"{path}: another kind of tokenizer")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.auto = Automaton([*letters, *(c + LAST for c in letters)], merges)
        self.id = [0] * len(self.auto.ids)
        self.label = {}
        for t, i in self.auto.ids.items():
            self.id[i] = vocab[t]
            self.label[vocab[t]] = t.encode()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label |= {i: t.encode() for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.library = Tokenizer.from_file(path)  # splits words with letters that are not settled
        self.words = regex.compile(split["pattern"]["Regex"])
        self.letter = dict(enumerate(letters))
        self.kept, self.kept_words = Recent(KEPT), Recent(KEPT // 4)

    def word(self, word: str, kept: Recent) -> tuple[int, bytes, bytes]:
        got = kept.get(word)
        if got is None:
            ids = [self.id[t] for t in self.auto.walk(word)]
            got = (len(ids), b"".join([b" %d" % i for i in ids]), self.emit(ids))
            if len(word) <= LONGEST:
                kept.put(word, got)
        return got

    def part(self, part: str) -> tuple[int, bytes, bytes]:
        """Number of tokens, decimal ids and labels, each after a space."""
        if part.isascii() and part.isalpha():
            return self.word(part.lower(), self.kept)
        found = []
        for k, piece in enumerate(self.cut.split(part) if self.cut and "<" in part else [part]):
            if k % 2:
                i = self.special[piece]
                found.append((1, b" %d" % i, b" " + self.label[i]))
            elif piece.isascii():
                spelt = self.words.findall(piece.lower())
                if not piece.isprintable():
                    spelt = [w.translate(self.letter) for w in spelt]
                # a printable ASCII word spells itself, so words and parts share what is kept
                found.extend([self.word(w, self.kept if w.isascii() else self.kept_words) for w in spelt])
            else:
                if max(piece) < SETTLED:
                    spelt = [w.encode().decode("latin-1").translate(self.letter)
                             for w in self.words.findall(unicodedata.normalize("NFC", piece).lower())]
                else:
                    spelt = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(
                        self.library.normalizer.normalize_str(piece))]
                found.extend([self.word(w, self.kept_words) for w in spelt])
        if len(found) == 1:
            return found[0]
        return sum([f[0] for f in found]), b"".join([f[1] for f in found]), b"".join([f[2] for f in found])

    def parts(self, text: str) -> Iterator[list[tuple[int, bytes, bytes]]]:
        """What ``part`` gives for the text's parts. A long text comes in
        segments."""
        at, kept = 0, self.kept
        while at < len(text):
            end = len(text)
            if end - at > SEGMENT:
                end = text.find(" ", at + SEGMENT)
                end = len(text) if end < 0 else end
            parts = text[at:end].replace("\n", " ").split(" ")
            at = end
            new, old = kept.new, kept.old
            out = []
            for p in parts:
                got = new.get(p)
                if got is None:
                    got = old.get(p)
                    if got is None:
                        got = self.part(p)
                    if len(p) <= LONGEST:
                        kept.put(p, got)
                        new, old = kept.new, kept.old
                out.append(got)
            yield out

    def emit(self, ids: list[int]) -> bytes:
        return b"".join([b" " + self.label[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        return [int(i) for some in self.parts(text) for _, ids, _ in some for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        return self.emit(ids)[1:].decode()

    def digests(self, text: str) -> tuple[int, str, str]:
        """(tokens, SHA-256 of the decimal ids, SHA-256 of the decoded text)."""
        n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        for some in self.parts(text):
            skip = 0 if n else 1  # the first token has no space before it
            ids_hash.update(b"".join([p[1] for p in some])[skip:])
            text_hash.update(b"".join([p[2] for p in some])[skip:])
            n += sum([p[0] for p in some])
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


_loaded: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """One per Python worker: rules are compiled once, known words stay."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def _map(src: DataFrame, path: str, column: str, made: list[tuple[str, pa.DataType, str]], do) -> DataFrame:
    kinds = dict(src.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                rows = [do(bpe(path), x.as_py()) for x in some.column(column)]
                cols = [pa.array([r[k] for r in rows], t) for k, (_, t, _) in enumerate(made)]
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("rest"), *cols],
                                                 names=["id", "rest", *(n for n, _, _ in made)])

    return src.mapInArrow(work, f"id {kinds['id']}, rest {kinds['rest']}, " + ", ".join(f"{n} {s}" for n, _, s in made))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, rest, ids`` (array of int) for each row.

    ``path`` must be readable on the workers. Defined cases: a null or empty
    text has no ids; a very long text is cut at spaces and read in segments;
    equal rows give equal rows; a null id is kept; an empty table gives none.
    """
    return _map(pack(docs, id_col, text_col), path, "text", [("ids", pa.list_(pa.int32()), "array<int>")],
                lambda b, t: (b.encode(t),))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``id, rest, text`` of rows with ``ids``: labels joined by one space, as
    the file's library decodes it (no decoder, special tokens kept)."""
    return _map(encoded.select("id", "rest", "ids"), path, "ids", [("text", pa.string(), "string")],
                lambda b, ids: (b.decode(ids or []),))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, rest, n_tokens, ids_sha256, decoded_sha256``: what ``encode`` and
    ``decode`` give, without moving ids and decoded texts out of the worker."""
    return _map(pack(docs, id_col, text_col), path, "text",
                [("n_tokens", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"),
                 ("decoded_sha256", pa.string(), "string")], lambda b, t: b.digests(t))


def q_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "rest.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
