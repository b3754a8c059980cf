"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

The vocabulary is read from a model file; nothing is trained. A text becomes
words (a run of blanks and what follows it) between which no piece of the
vocabulary reaches, so each word is encoded on its own. All words that a task
has not met yet are encoded together as flat numpy arrays: every round looks up
the rank of each adjacent symbol pair, takes the minimum per word with a
segmented reduction, merges all leftmost non-overlapping pairs of that rank at
once, and compacts the arrays, until no word has a pair left.

Merging one rank at once equals merging one pair at a time unless a merge makes
a pair of the same or a lower rank; in such a word only the leftmost pair is
merged in that round, which is exact in every case.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from tradescope.llm.common import documents_of, map_rows, sha256_hex

BLANK = "▁"
NO_RANK = np.int64(2**62)
#: Words kept encoded per Python worker; the cache is emptied beyond it.
CACHE_WORDS = 1_000_000
#: Longer words are looked through for places that no piece spans.
LONG_WORD = 48
#: Marks that mostly stand behind a word; where no piece joins them to it they are words of their own.
MARKS = "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~"


class MergeEncoder:
    """Encodes words with the merges that a SentencePiece BPE model implies."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp, n = self.library, self.library.get_piece_size()
        pieces = {}
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                pieces[piece] = i
        self.has_bytes = any(sp.is_byte(i) for i in range(n))
        self.unknown_id = sp.unk_id()
        # Symbols are pieces, and characters that only occur inside longer pieces.
        self.symbols = dict(pieces)
        for piece in pieces:
            for ch in piece:
                self.symbols.setdefault(ch, n + len(self.symbols))
        self.n_pieces = n
        scores = sorted({sp.get_score(i) for i in pieces.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        pairs = []
        for piece, i in pieces.items():
            for k in range(1, len(piece)):
                left, right = self.symbols.get(piece[:k]), self.symbols.get(piece[k:])
                if left is not None and right is not None:
                    pairs.append(((left << 32) | right, rank_of[sp.get_score(i)], i))
        self._build_table(pairs)
        self.inner = {piece[k : k + 2] for piece in pieces for k in range(len(piece) - 1)}
        # Runs of blanks: pieces of 2..m blanks that share the lowest score are merged from the left, m at a time.
        runs = sorted(len(p) for p in pieces if len(p) > 1 and not p.strip(BLANK))
        tied = {sp.get_score(pieces[BLANK * k]) for k in runs}
        self.run = runs[-1] if runs and runs == list(range(2, runs[-1] + 1)) and tied == {scores[-1]} else 0
        # A piece with a blank after another character would join words.
        self.split = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+") if not any(p[1] == BLANK != p[0] for p in self.inner) else re.compile(r"(?s).+")
        self.lines_apart = not any("\n" in p for p in pieces)
        self.ids_text = [str(i) for i in range(n)]
        self.code = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}

    def _build_table(self, pairs: list[tuple[int, int, int]]) -> None:
        """Open-addressed table of pair codes; a lookup then is one gather for nearly every pair."""
        bits = max(4, (8 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table_code = np.full(2**bits, -1, dtype=np.int64)
        self.table_rank = np.full(2**bits, NO_RANK, dtype=np.int64)
        self.table_new = np.zeros(2**bits, dtype=np.int64)
        codes = np.array([p[0] for p in pairs], dtype=np.int64)
        for (code, rank, new), slot in zip(pairs, self._slot(codes).tolist(), strict=True):
            while self.table_code[slot] not in (-1, code):
                slot = (slot + 1) % len(self.table_code)
            self.table_code[slot], self.table_rank[slot], self.table_new[slot] = code, rank, new

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    # -- rounds -----------------------------------------------------------
    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code = (left << 32) | (right & 0xFFFFFFFF)
        slot = self._slot(code)
        found = self.table_code[slot]
        rank, new = np.where(found == code, self.table_rank[slot], NO_RANK), self.table_new[slot]
        rest = np.flatnonzero((found != code) & (found != -1))
        while len(rest):  # collisions
            slot[rest] = (slot[rest] + 1) % len(self.table_code)
            found = self.table_code[slot[rest]]
            hit = rest[found == code[rest]]
            rank[hit], new[hit] = self.table_rank[slot[hit]], self.table_new[slot[hit]]
            rest = rest[(found != code[rest]) & (found != -1)]
        return rank, new

    def merge_rounds(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat symbols and their word numbers (ascending) -> the same after all merges."""
        done_sym, done_word = [], []
        while len(sym):
            same = word[1:] == word[:-1]
            rank, new = self._lookup(sym[:-1], sym[1:])
            rank = np.where(same, rank, NO_RANK)
            starts = np.flatnonzero(np.r_[True, ~same])
            lowest = np.minimum.reduceat(np.r_[rank, NO_RANK], starts)  # a word's last symbol has no pair in it
            sizes = np.diff(np.r_[starts, len(sym)])
            open_word = lowest < NO_RANK
            if not open_word.all():  # compaction: words without a pair leave
                stays = np.repeat(open_word, sizes)
                done_sym.append(sym[~stays])
                done_word.append(word[~stays])
                if not stays.any():
                    sym, word = sym[:0], word[:0]
                    break
                sym, word = sym[stays], word[stays]
                continue
            low = np.repeat(lowest, sizes)
            hit = np.r_[rank, NO_RANK] == low
            hit = self._leftmost(hit)
            first = np.zeros(len(sym), dtype=bool)
            at = np.flatnonzero(hit)
            first[at[np.r_[True, word[at[1:]] != word[at[:-1]]]]] = True
            out_sym, out_word = self._apply(sym, word, hit, new)
            risky = self._made_lower(sym, word, hit, new, low)
            if risky is not None:
                only_first = np.isin(word, risky)
                out_sym, out_word = self._apply(sym, word, np.where(only_first, first, hit), new)
            sym, word = out_sym, out_word
        done_sym.append(sym)
        done_word.append(word)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    @staticmethod
    def _leftmost(hit: np.ndarray) -> np.ndarray:
        """Of overlapping pairs (a run of neighbouring hits) every second one, from the left."""
        index = np.arange(len(hit))
        begins = hit & ~np.r_[False, hit[:-1]]
        run_start = np.maximum.accumulate(np.where(begins, index, 0))
        return hit & ((index - run_start) % 2 == 0)

    @staticmethod
    def _apply(sym: np.ndarray, word: np.ndarray, hit: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = sym.copy()
        at = np.flatnonzero(hit)
        out[at] = new[at]
        keep = np.ones(len(sym), dtype=bool)
        keep[at + 1] = False
        return out[keep], word[keep]

    def _made_lower(self, sym, word, hit, new, low) -> np.ndarray | None:
        """Words with several merges in which one could come after a new pair of no higher rank."""
        at = np.flatnonzero(hit)
        several = np.r_[False, word[at[1:]] == word[at[:-1]]] | np.r_[word[at[1:]] == word[at[:-1]], False]
        at = at[several]
        if not len(at):
            return None
        after, n = np.minimum(at + 2, len(sym) - 1), len(sym)
        merged, bound = new[at], low[at]
        right_in = (at + 2 < n) & (word[after] == word[at])
        before = np.maximum(at - 1, 0)
        left_in = (at > 0) & (word[before] == word[at])
        bad = np.zeros(len(at), dtype=bool)
        both = np.r_[hit, False, False]
        for left, right, valid in (
            (merged, sym[after], right_in),
            (merged, np.where(both[after], new[np.minimum(after, len(new) - 1)], sym[after]), right_in),
            (sym[before], merged, left_in),
        ):
            rank, _ = self._lookup(left, right)
            bad |= valid & (rank <= bound)
        return np.unique(word[at[bad]]) if bad.any() else None

    # -- words ------------------------------------------------------------
    def _parts(self, w: str) -> list[str]:
        """Cuts a word where no piece of the vocabulary reaches across."""
        if len(w) <= LONG_WORD:
            core = w.rstrip(MARKS)
            k = len(core)
            return [core, w[k:]] if 0 < k < len(w) and w[k - 1 : k + 1] not in self.inner else [w]
        cuts = [k + 1 for k in range(len(w) - 1) if w[k : k + 2] not in self.inner]
        parts = [w[a:b] for a, b in zip([0, *cuts], [*cuts, len(w)], strict=True)]
        out = []
        for p in parts:
            blanks = len(p) - len(p.lstrip(BLANK))
            while self.run and blanks > 2 * self.run:
                out.append(p[: self.run])
                p, blanks = p[self.run :], blanks - self.run
            out.append(p)
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian numbers."""
        per_word = [self._parts(w) for w in words]
        distinct = list(dict.fromkeys(p for parts in per_word for p in parts))
        chars = "".join(distinct)
        alphabet = set(chars)
        unseen = {ch: -2 - i for i, ch in enumerate(sorted(alphabet - self.symbols.keys()))}
        code_of = {ch: unseen[ch] if ch in unseen else self.symbols[ch] for ch in alphabet}
        sym = np.fromiter(map(code_of.__getitem__, chars), dtype=np.int64, count=len(chars))
        word = np.repeat(np.arange(len(distinct)), np.fromiter(map(len, distinct), dtype=np.int64, count=len(distinct)))
        # Unknown characters have no pair; their negative codes are never in the table.
        sym, word = self.merge_rounds(sym, word)
        whole = (sym >= 0) & (sym < self.n_pieces)
        odd = set(word[~whole].tolist())
        text_of = {v: k for k, v in code_of.items()}
        ends = (np.searchsorted(word, np.arange(len(distinct)), side="right") * self.code.itemsize).tolist()
        flat = np.where(whole, sym, 0).astype(self.code).tobytes()
        encoded, begin = {}, 0
        for k, (p, end) in enumerate(zip(distinct, ends, strict=True)):
            encoded[p] = flat[begin:end]
            if k in odd:
                ids = sym[begin // self.code.itemsize : end // self.code.itemsize].tolist()
                ids = [i for s in ids for i in ([s] if 0 <= s < self.n_pieces else self._fallback(text_of[s]))]
                encoded[p] = np.array(ids, dtype=self.code).tobytes()
            begin = end
        return [encoded[p[0]] if len(p) == 1 else b"".join(map(encoded.__getitem__, p)) for p in per_word]

    def _fallback(self, ch: str) -> list[int]:
        return [int(self.byte_ids[b]) for b in ch.encode("utf-8", "surrogatepass")] if self.has_bytes else [self.unknown_id]

    # A key of the cache is a word; one blank before it is left out, unless a blank or a line break comes first.
    def keys_of(self, text: str) -> list[str]:
        if not text:
            return []
        plain = self.lines_apart and BLANK not in text and "  " not in text and " \n" not in text and text[0] not in " \n" and text[-1] != " "
        if plain:
            return text.replace("\n", " \n").split(" ")
        words = self.split.findall((BLANK + text).replace(" ", BLANK))
        return [w[1:] if len(w) > 1 and w[1] not in (BLANK, "\n") else w for w in words]

    @staticmethod
    def _word_of(key: str) -> str:
        return key if key[0] in (BLANK, "\n") else BLANK + key

    def learn(self, per_text: list[list[str]]) -> None:
        met = set().union(*per_text)
        missing = met.difference(self.cache)
        if len(self.cache) + len(missing) > CACHE_WORDS:
            self.cache.clear()
            missing = met
        missing = list(missing)
        step = 50_000
        for k in range(0, len(missing), step):
            part = missing[k : k + step]
            self.cache.update(zip(part, self.encode_words([self._word_of(w) for w in part]), strict=True))

    def encode(self, texts: list[str]) -> list[list[int]]:
        per_text = [self.keys_of(t) for t in texts]
        self.learn(per_text)
        return [np.frombuffer(b"".join(map(self.cache.__getitem__, keys)), dtype=self.code).tolist() for keys in per_text]

    def ids_as_text(self, ids: list[int]) -> str:
        return ",".join(map(self.ids_text.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def encoder(model_file: str) -> MergeEncoder:
    """One encoder, with its cache of words, per Python worker."""
    return MergeEncoder(model_file)


#: Texts are encoded together up to about so many characters.
CHARS_AT_ONCE = 400_000


def groups_by_size(texts: list[str], limit: int = CHARS_AT_ONCE) -> list[tuple[int, int]]:
    """Index ranges of neighbouring texts of up to ``limit`` characters (one text at least)."""
    out, begin, size = [], 0, 0
    for k, t in enumerate(texts):
        if k > begin and size + len(t) > limit:
            out.append((begin, k))
            begin, size = k, 0
        size += len(t)
    if begin < len(texts):
        out.append((begin, len(texts)))
    return out


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, ids array<int>`` of each whole text; null or empty texts give no ids."""

    def run(cols):
        texts = cols["text"]
        ids = [i for a, b in groups_by_size(texts) for i in encoder(model_file).encode(texts[a:b])]
        return {"doc_id": cols["doc_id"], "ids": ids}

    return map_rows(documents_of(docs), run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """Encodes and decodes every whole text.

    Returns ``doc_id, n_tokens, ids_sha256`` (decimal ids joined by commas) and
    ``decoded_sha256`` (UTF-8 of the decoded text). One row per input row:
    repeated rows stay repeated, a null text counts as empty, a null doc_id is
    kept as null.
    """

    def run(cols):
        enc, out = encoder(model_file), {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        texts = cols["text"]
        for a, b in groups_by_size(texts):
            for ids in enc.encode(texts[a:b]):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha256_hex(enc.ids_as_text(ids)))
                out["decoded_sha256"].append(sha256_hex(enc.decode(ids)))
        return out

    return map_rows(documents_of(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
