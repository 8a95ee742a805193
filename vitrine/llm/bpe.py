"""Byte-level BPE ids of whole texts from a public ``tokenizer.json``.

The vocabulary and merge order come from the ``tokenizers`` file; its ids are the merge ranks, so the same file also
drives the faster encoder of ``tiktoken`` (the tests compare both).  ``Encoder.encode`` gives the plain library call's
ids: a text that holds the string of an added token, or that the fast encoder cannot take (very long runs of white
space), goes through ``tokenizers`` itself.  ``Encoder.encode_ordinary`` reads strings of added tokens as ordinary text, so
that a text may be cut at any border of pre-tokens.
"""

from __future__ import annotations

import json

#: Fixed value: the pre-token pattern of the byte-level pre-tokeniser.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken

        self.path = path
        self._slow = None
        spec = json.load(open(path, encoding="utf-8"))
        special = self._added = {t["content"] for t in spec["added_tokens"]}
        back = _byte_of_char()
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self._fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _library(self, text: str, as_text: bool) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        self._slow.encode_special_tokens = as_text
        return self._slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if any(t in text for t in self._added):
            return self._library(text, False)
        return self.encode_ordinary(text)

    def encode_ordinary(self, text: str) -> list[int]:
        try:
            return self._fast.encode_ordinary(text)
        except BaseException as e:  # the fast encoder's panic is no Exception
            if type(e).__name__ != "PanicException":
                raise
        return self._library(text, True)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
