"""Token ids of whole texts, as the library of a public tokenizer file gives them.

``Encoder(path)`` loads a ``tokenizers`` JSON file or a ``sentencepiece``
model. For a byte-level BPE file with a twin ``.tiktoken`` file of the same
vocabulary beside it, plain texts take a faster road to the same ids: the
twin's ranks with a split pattern that has no look-ahead. A text is plain if
it fits Latin-1 (all Unicode tables agree there), holds no two white-space
characters in a row (the look-ahead only decides how such runs split) and no
special string. All other texts go to the library itself. The tests hold
both roads against each other.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re

# Fixed value: the split pattern of the byte-level BPE file, without its look-ahead branch.
PLAIN_SPLIT = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
SPACES = re.compile(r"\s\s")


def default_tokenizer() -> str:
    """Place of ``byte_bpe_50k.json`` among the public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def version(path: str) -> str:
    """Digest of the tokenizer file: equal files count alike, whatever their place."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Encoder:
    """``ids(text)``: list of token ids without begin, end or added special tokens."""

    def __init__(self, path: str, twin: bool = True):
        self.plain = None
        self.special: tuple[str, ...] = ()
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda text: model.encode(text, num_threads=1)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.library = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        ranks = path.removesuffix(".json") + ".tiktoken"
        if twin and os.path.exists(ranks) and self._byte_level(path):
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.plain = tiktoken.Encoding("plain", pat_str=PLAIN_SPLIT, mergeable_ranks=table,
                                           special_tokens={}).encode_ordinary

    def _byte_level(self, path: str) -> bool:
        """True if the file splits by the byte-level pattern and does nothing else to a text."""
        with open(path) as f:
            spec = json.load(f)
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        split = spec["pre_tokenizer"] or {}
        return (spec["normalizer"] is None and split.get("type") == "ByteLevel"
                and split.get("use_regex", True) and not split.get("add_prefix_space")
                and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
                and all(not t["lstrip"] and not t["rstrip"] for t in spec["added_tokens"]))

    def ids(self, text: str) -> list[int]:
        if self.plain is not None and not SPACES.search(text) and not any(s in text for s in self.special):
            try:
                text.encode("latin-1")
                return self.plain(text)
            except UnicodeEncodeError:
                pass
        return self.library(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file; loaded once per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
