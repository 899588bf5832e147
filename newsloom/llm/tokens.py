"""Token counts by a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import base64
from functools import cache

#: The vocabulary file that queries use; any of the kinds below may stand here.
DEFAULT = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the word pattern that belongs to the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizer:
    """Counts tokens; ``path`` ends in .tiktoken (ranks), .json (tokenizers) or .model (sentencepiece)."""

    def __init__(self, path: str):
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            encode = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.counts = lambda texts: [len(encode(t)) for t in texts]
        elif path.endswith(".json"):
            from tokenizers import Tokenizer as Fast

            fast = Fast.from_file(path)
            fast.encode_special_tokens = True
            self.counts = lambda texts: [len(e.ids) for e in fast.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import sentencepiece

            piece = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(x) for x in piece.encode(texts, num_threads=1)] if texts else []

    def count(self, text: str) -> int:
        return self.counts([text])[0]


@cache
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer a process and file."""
    return Tokenizer(path)
