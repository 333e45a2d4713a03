"""Where the tokenizer's file is (a parameter of the operators)."""

from __future__ import annotations


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Path of a vocabulary file of the public tokenizers; every executor has
    them at the same place."""
    import public_tokenizers
    return str(public_tokenizers.path(name))
