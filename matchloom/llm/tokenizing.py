"""Token ids of whole texts: each distinct word of a batch is encoded once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: signs that a word can end with; after a letter, the tokenizer keeps a run of them together
SIGNS = ".,;:!?#%&*$|()\"-"
#: words encoded at once, bytes of text looked at together
AT_ONCE, TOGETHER = 500, 2 << 20
END = 1
#: letters that stand for themselves in normal form and have one lower case, the library's
LETTERS = "^[A-Za-zª-ºµÀ-ÖØ-öø-įı-ſ]+"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


class WordTokenizer:
    """Equal to ``Tokenizer.encode(text, add_special_tokens=False)`` for word_bpe_49k.json.

    That tokenizer drops white space and joins nothing across it, so a text's ids are the ids of
    its pieces between ASCII white space. The distinct pieces of some megabytes of text are encoded
    once. A text that holds the literal of a special token goes to the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # words of letters need no normal form and no pattern: white space parts them
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = [i for w, i in self.tokenizer.get_vocab().items() if w.endswith("</w>")]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends_word[ends] = True

    def _whole(self, pieces: list[str]) -> pa.ListArray:
        """Ids of any pieces, each on its own."""
        found = [e.ids for a in range(0, len(pieces), AT_ONCE) for e in self.tokenizer.encode_batch_fast(pieces[a : a + AT_ONCE], add_special_tokens=False)]
        return pa.array(found, pa.list_(pa.uint32()))

    def _words(self, words: list[str]) -> pa.ListArray:
        """Ids of lower-case words of letters, many at once: each ends with an id that says so."""
        parts = [self.plain.encode_batch_fast([" ".join(words[a : a + AT_ONCE])], add_special_tokens=False)[0].ids for a in range(0, len(words), AT_ONCE)]
        ids = np.concatenate([np.array(p, np.uint32) for p in parts]) if parts else np.zeros(0, np.uint32)
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stops) != len(words):
            raise AssertionError("a word of letters came apart")
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(ids))

    def _pieces(self, pieces: pa.Array) -> pa.ListArray:
        """The ids of each piece, any text without ASCII white space and special literals."""
        core = pc.utf8_rtrim(pieces, SIGNS)
        of_letters = pc.match_substring_regex(core, LETTERS + "$")
        inside = of_letters.to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(core.filter(of_letters)).dictionary_encode()
        tails = pc.replace_substring_regex(pieces.filter(of_letters), LETTERS, "").dictionary_encode()
        heads = self._words(words.dictionary.to_pylist()).take(words.indices)
        ends = self._whole(tails.dictionary.to_pylist()).take(tails.indices)
        others = self._whole(pieces.filter(pc.invert(of_letters)).to_pylist())
        # a head and its end, or the whole piece: rows of one list after the other
        lists = pa.concat_arrays([heads, ends, others])
        n, at = len(heads), np.zeros((len(pieces), 2), np.int64)
        at[inside] = np.stack([np.arange(n), n + np.arange(n)], axis=1)
        at[~inside] = np.stack([2 * n + np.arange(len(others)), np.full(len(others), len(lists))], axis=1)  # the last list is empty
        both = pa.concat_arrays([lists, pa.array([[]], lists.type)]).take(pa.array(at.ravel()))
        return pa.ListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.values)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row (unsigned 32 bits), and where each text's end; null counts as empty."""
        texts = pc.fill_null(texts, "")
        odd = np.zeros(len(texts), bool)
        for literal in self.special:
            odd |= pc.match_substring(texts, literal).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        pieces = pc.ascii_split_whitespace(plain)
        places = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        lists = self._pieces(coded.dictionary).take(coded.indices)
        sums = lists.offsets.to_numpy()
        out = lists.values.to_numpy()
        ends = sums[places[1:] - places[0]].astype(np.int64)
        if odd.any():
            parts, begin = [], 0
            for k, end in enumerate(ends):
                parts.append(np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, "<u4") if odd[k] else out[begin:end])
                begin = end
            out, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return out, ends

    def batches(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, ends) of consecutive texts of some megabytes, so that memory stays bounded.

        Workers outlive their tasks, so what Arrow has set by goes back to the system after each array of texts.
        """
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // TOGETHER
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield a, *self.ids(texts.slice(a, b - a))
        pa.default_memory_pool().release_unused()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for _, ids, ends in self.batches(pa.array(texts, pa.string())):
            out += [part.tobytes() for part in np.split(ids, ends[:-1])]
        return out


_READY: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and file."""
    if path not in _READY:
        _READY[path] = WordTokenizer(path)
    return _READY[path]
