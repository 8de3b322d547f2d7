"""BPE encoding and decoding by a prefix-sharing walk over a trie of words.

The distinct words of a batch are sorted, which is a depth-first walk of their trie: a word keeps
the states of the prefix it shares with the word before and computes only the rest.  The state of a
prefix is the last token of its encoding.  A token may end a prefix exactly if it is a suffix of it
and forms an encoding of its own with the last token of what stands before; walking back over last
tokens gives the whole encoding.  Words seen before come from a bounded memory of the worker.

The tokenizer file's own normalizer and pre-tokenizer decide what a word is.  Null and empty texts
encode to no ids and decode to an empty text; equal rows give equal results; a null id is kept;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

WORD_ENTRIES = 700_000  # remembered words of a worker: a memory bound, never a cap on results
PAIR_ENTRIES = 2_000_000


class Trie:
    """Encodings of words under merge rules whose last symbol carries an end-of-word mark."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        self.vocab, self.end = vocab, end
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.rank = {p: i for i, p in enumerate(pairs)}
        # reach[s]: longest token, so that no longer suffix is tried
        self.longest = max((len(t) - (len(end) if t.endswith(end) else 0) for t in vocab), default=1)
        self.alone: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def by_rules(self, symbols: list[str]) -> list[str]:
        """Tokens by applying the merge rules, lowest rank and leftmost first."""
        rank = self.rank
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=lambda p: rank.get(p, 1 << 60))
            if best not in rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(best[0] + best[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            s = list(token[:-len(self.end)])
            s[-1] += self.end
            return s
        return list(token)

    def stands(self, token: str) -> bool:
        ok = self.alone.get(token)
        if ok is None:
            ok = self.alone[token] = self.by_rules(self.symbols(token)) == [token]
        return ok

    def fits(self, left: str, right: str) -> bool:
        """Whether ``left`` followed by ``right`` encodes to just these two tokens."""
        ok = self.pairs.get((left, right))
        if ok is None:
            ok = self.by_rules(self.symbols(left) + self.symbols(right)) == [left, right]
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            self.pairs[(left, right)] = ok
        return ok

    def _last(self, word: str, upto: int, states: list[str], end: str) -> str | None:
        """Last token of the prefix of length ``upto``, given the states of the shorter ones."""
        vocab = self.vocab
        for start in range(max(0, upto - self.longest), upto):
            token = word[start:upto] + end
            if token in vocab:
                if start == 0:
                    if self.stands(token):
                        return token
                elif states[start] is not None and self.fits(states[start], token):
                    return token
        return None

    def encode(self, words: list[str]) -> dict[str, list[str]]:
        """Tokens of each word."""
        out: dict[str, list[str]] = {}
        states: list[str | None] = [None]  # states[i]: last token of the prefix of length i
        before = ""
        for word in sorted(words):
            shared, limit = 0, min(len(before), len(word), len(states) - 1)
            while shared < limit and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1:]
            for i in range(len(states), len(word)):
                states.append(self._last(word, i, states, ""))
            before = word
            token, at, tokens = self._last(word, len(word), states, self.end), len(word), []
            while token is not None:
                tokens.append(token)
                at -= len(token) - (len(self.end) if at == len(word) else 0)
                if not at:
                    break
                token = states[at]
            # symbols outside the vocabulary leave a prefix without a state
            out[word] = tokens[::-1] if token is not None and not at else [
                t for t in self.by_rules(self.symbols(word + self.end)) if t in self.vocab]
        return out


class WordBpe:
    """Encoder and decoder of a tokenizer file with an end-of-word mark and no decoder of its own."""

    # words of lower-case texts up to U+017F, where composing characters changes nothing
    latin = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                       r"|[^ \t\n\x0b\x0c\r\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f0-9\xb2\xb3\xb9\xbc-\xbe]+")
    beyond = re.compile(r"[^\x00-\u012f\u0131-\u017f]|<\|")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        model = json.loads(self.tok.to_str())["model"]
        self.vocab = model["vocab"]
        self.trie = Trie(self.vocab, model["merges"], model["end_of_word_suffix"])
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.char = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.reset()

    def reset(self) -> None:
        """Forget the words seen so far.  Keys hold words before the byte-level alphabet; special
        tokens stand for themselves (no word contains one)."""
        self.ids: dict[str, bytes] = {t: array("I", [i]).tobytes() for t, i in self.special.items()}
        self.tokens: dict[str, str] = {t: t for t in self.special}

    def words(self, text: str) -> list[str]:
        if not self.beyond.search(text):
            return self.latin.findall(text.lower())
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                norm = self.tok.normalizer.normalize_str(part)
                # offsets point into the normalized text, so words keep the same keys as above
                out += [norm[i:j] for _, (i, j) in self.tok.pre_tokenizer.pre_tokenize_str(norm)]
        return out

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        char, vocab = self.char, self.vocab
        spelt = {w: w if w.isascii() and w.isprintable() else "".join([char[b] for b in w.encode()])
                 for w in words}
        tokens = self.trie.encode(list(spelt.values()))
        for w, s in spelt.items():
            found = tokens[s]
            self.ids[w] = array("I", [vocab[t] for t in found]).tobytes()
            self.tokens[w] = " ".join(found)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Little-endian ids and decoded text of each text."""
        if len(self.ids) > WORD_ENTRIES:
            self.reset()
        split = [self.words(t) for t in texts]
        new = set().union(*split).difference(self.ids)
        if new:
            self.learn(list(new))
        ids, tokens = self.ids.__getitem__, self.tokens.__getitem__
        return [(b"".join(map(ids, ws)), " ".join(map(tokens, ws))) for ws in split]


_BPE: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    if path not in _BPE:
        _BPE[path] = WordBpe(path)
    return _BPE[path]


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", keep: bool = True) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``keep``, ``ids``
    (little-endian unsigned 32-bit) and ``decoded``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, 8 << 20):
                got = bpe.encode(texts[a:b])
                cols = [batch.column("id").slice(a, b - a),
                        pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i, _ in got]),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in got])]
                if keep:
                    cols += [pa.array([i for i, _ in got], pa.binary()), pa.array([d for _, d in got])]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" * keep
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
