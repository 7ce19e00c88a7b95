"""Byte-pair lookups for single pre-tokens of a tokenizers file, with bounded caches for Python workers."""

import os

MAX_CACHED = 500_000


def load(path: str):
    """The tokenizer of a ``.json`` file; its threads stay off because Spark already runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE files use for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()


def shown(pre_token: str) -> str:
    """A pre-token as the letters that stand for its bytes; printable ASCII stands for itself."""
    if pre_token.isascii() and pre_token.isprintable() and " " not in pre_token:
        return pre_token
    return pre_token.encode().decode("latin-1").translate(LETTERS)


def ids_of(tokenizer, pre_token: str) -> list[int]:
    """Ids of one pre-token that the tokenizer's normalizer has already seen."""
    return [t.id for t in tokenizer.model.tokenize(shown(pre_token))]


class Cache(dict):
    """A dict that works out what it misses and starts again from its fixed entries beyond ``most``."""

    def __init__(self, work_out, fixed: dict | None = None, most: int = MAX_CACHED):
        super().__init__(fixed or {})
        self.work_out, self.fixed, self.most = work_out, fixed or {}, most

    def __missing__(self, key):
        if len(self) >= self.most + len(self.fixed):
            self.clear()
            self.update(self.fixed)
        value = self[key] = self.work_out(key)
        return value
