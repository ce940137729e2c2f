"""Public tokenizers applied to many texts.

The output of both equals that of the file's library on the whole text; the tests compare the two. Ids come from the fastest
merger that is shown to give the library's; counts come from a bounded table of words, cut where no token crosses.
"""

from __future__ import annotations

import os
import re

from .common import claim

#: Pieces kept by a worker between batches; the table is emptied when it grows beyond this.
CACHE_ENTRIES = 500_000
#: Longer pieces are encoded each time and not kept.
CACHE_CHARS = 48

_CODERS: dict[tuple[str, str], object] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file by name; absolute paths are taken as they are."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteEncoder:
    """Ids by a byte-level BPE file of the tokenizers library, no special tokens added, as little-endian uint32 bytes.

    Where the file is plain byte-level BPE whose merges make the ids in their order, lowest rank first is lowest id first, and
    tiktoken's merger over the file's own vocabulary gives the library's ids; the tests compare the two, on every code point among
    others. A file that is not so, a text with an added token's string in it, and one with a run of white space too long for that
    merger's pattern go to the library whole. Nothing is kept between texts, so that a worker's memory does not grow.
    """

    #: Texts up to this length can't have a run of white space that is too long.
    SHORT = 20_000
    _RUN = re.compile(r"\s{20000}")

    def __init__(self, path: str):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            self.merger = self._merger(json.load(f))

    @staticmethod
    def _merger(spec: dict):
        """The merger over the file's vocabulary, or None where its ids can't be taken for ranks."""
        import tiktoken
        from public_tokenizers import PATTERN

        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and spec.get("normalizer") is None and not model.get("dropout") and not model.get("ignore_merges")
        plain = plain and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "unk_token"))
        plain = plain and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        letters, vocab = _byte_letters(), model["vocab"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranks = [vocab.get(t, -1) for t in merged]
        if not plain or len(set(merged)) != len(merged) or ranks != sorted(ranks) or min(ranks, default=0) < len(letters):
            return None
        known = {bytes(letters[c] for c in t): i for t, i in vocab.items() if all(c in letters for c in t) and (len(t) == 1 or i >= ranks[0])}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})

    def whole(self, texts: list[str]) -> list[bytes]:
        """The library's own ids."""
        import numpy as np

        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.merger is None:
            return self.whole(texts)
        ids, added = self.merger.encode_to_numpy, self.added
        out = []
        for text in texts:
            odd = any(a in text for a in added) or len(text) > self.SHORT and self._RUN.search(text)
            out.append(self.whole([text])[0] if odd else ids(text).astype("<u4", copy=False).tobytes())
        return out


class PieceCounter:
    """Token counts by a sentencepiece BPE file whose text is not normalised and whose pieces hold a space only at their head.

    Whole-token shortcut: each vocabulary string that, encoded alone, is shown here to be one token is counted
    without merging; other words go to the library, whose counts are kept. Cuts are made before spaces and line
    feeds; the constructor proves from the vocabulary that no piece crosses such a cut, and refuses
    a model where that fails.
    """

    _WORDS = re.compile("▁+[^▁\n]*|\n[^▁\n]*")

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm = spec.normalizer_spec
        pieces = [p.piece for p in spec.pieces]
        sound = norm.add_dummy_prefix and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap and spec.trainer_spec.model_type == 2
        sound = sound and "<0x0A>" in pieces and not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces) and "▁" in pieces and not any(p.type == 4 for p in spec.pieces)
        if not sound:
            raise ValueError(f"{path}: texts can't be cut at spaces and line feeds under this model")
        candidates = [p[1:] for p in pieces if len(p) > 1 and p[0] == "▁" and p[1] != "▁"]
        self.whole_tokens = {w: 1 for w, ids in zip(candidates, self.sp.encode(candidates, num_threads=1), strict=True) if len(ids) == 1}
        self.feed = self.sp.piece_to_id("<0x0A>")
        self.cache = dict(self.whole_tokens)

    def _count(self, words: list[str]) -> list[int]:
        """Counts of words that follow a space, or with a line feed at their head; encoded together, with line feeds between, and told apart by those."""
        import numpy as np

        counts = []
        for text, extra in (("x" + "".join(w for w in words if w[:1] == "\n"), 1), ("x" + "".join("\n " + w for w in words if w[:1] != "\n"), 0)):
            at = np.flatnonzero(np.append(self.sp.encode(text), self.feed) == self.feed)
            counts.append(iter((np.diff(at) - 1 + extra).tolist()))
        return [next(counts[w[:1] != "\n"]) for w in words]

    def count(self, texts: list[str]) -> list[int]:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache = dict(self.whole_tokens)
        cache, plans, missing = self.cache, [], set()
        for text in texts:
            if not text:
                plans.append([])
                continue
            if "  " in text or " \n" in text or "▁" in text or text[0] in " \n" or text[-1] == " ":
                words = [w if w[0] == "\n" else " " * (len(w) - len(w.lstrip("▁")) - 1) + w.lstrip("▁") for w in self._WORDS.findall("▁" + text.replace(" ", "▁"))]
            else:
                words = text.replace("\n", " \n").split(" ")
            missing.update(set(words).difference(cache))
            plans.append(words)
        fresh = list(missing)
        for at in range(0, len(fresh), 4096):
            block = fresh[at : at + 4096]
            cache.update(zip(block, self._count(block), strict=True))
        out = [sum(map(cache.__getitem__, words)) for words in plans]
        for w in fresh:
            if len(w) > CACHE_CHARS:
                del cache[w]
        return out


def _coder(kind: str, path: str, make: type) -> object:
    claim(f"{kind} {path}", _CODERS.clear)
    if (kind, path) not in _CODERS:
        _CODERS[kind, path] = make(path)
    return _CODERS[kind, path]


def byte_encoder(path: str) -> ByteEncoder:
    """The worker's encoder for ``path``, which outlives the task."""
    return _coder("byte", path, ByteEncoder)


def piece_counter(path: str) -> PieceCounter:
    return _coder("piece", path, PieceCounter)
