"""Token ids of whole texts by byte-level BPE.

The ids are those of ``tokenizers`` with the vocabulary's JSON file and ``add_special_tokens=False``;
``tiktoken`` reads the same vocabulary as ranks and is four times as fast. Added tokens of the JSON
file, such as <|endoftext|>, are recognised inside texts.
"""

from __future__ import annotations

import base64
import json
import os

import numpy as np

# Fixed value: how byte-level BPE cuts a text into pieces.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_loaded: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the JSON file beside the ranks; none without such a file."""
    beside = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for token in tokens:
        if any(token[flag] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{token['content']}: only tokens that match as they are can be added")
    return {token["content"]: token["id"] for token in tokens}


def encoding(path: str):
    """The vocabulary of ranks at ``path``, loaded once a worker process."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        _loaded[path] = tiktoken.Encoding(
            os.path.basename(path),
            pat_str=PIECES,
            mergeable_ranks=ranks,
            special_tokens=added_tokens(path),
        )
    return _loaded[path]


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Unsigned 32-bit ids; null is empty."""
    if not text:
        return np.zeros(0, np.uint32)
    return np.array(encoding(path).encode(text, allowed_special="all"), np.uint32)


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ByteLevel:
    """The byte-level vocabulary without its added tokens, and the bytes each id stands for."""

    def __init__(self, path: str) -> None:
        self._encoding = encoding(path)
        self.token_bytes = [self._encoding.decode_single_token_bytes(i) for i in range(self._encoding.n_vocab)]

    def encode_behind_space(self, texts: list[str]) -> list[list[int]]:
        return [self._encoding.encode_ordinary(" " + text) for text in texts]


class Pieces:
    """A model of pieces with byte fallback, and the bytes each id stands for."""

    # The mark of a space, and how byte pieces are written.
    SPACE, BYTE = "\u2581", slice(3, 5)

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self._model.vocab_size()
        if any(self.SPACE in self._model.id_to_piece(i).lstrip(self.SPACE) for i in range(size)):
            raise ValueError(f"{path}: texts cannot be cut at spaces, some pieces reach across")
        self.token_bytes = [self._bytes(i) for i in range(size)]

    def _bytes(self, number: int) -> bytes:
        if self._model.is_unknown(number) or self._model.is_control(number):
            return b""
        piece = self._model.id_to_piece(number)
        if self._model.is_byte(number):
            return bytes([int(piece[self.BYTE], 16)])
        return piece.replace(self.SPACE, " ").encode()

    def encode_behind_space(self, texts: list[str]) -> list[list[int]]:
        """The model itself puts the space before a text, unless there is none."""
        alone = self._model.piece_to_id(self.SPACE)
        return [ids or [alone] for ids in self._model.encode(texts, num_threads=1)]


def byte_level(path: str) -> ByteLevel:
    """Loaded once a worker process, as is :func:`pieces`."""
    if ("bytes", path) not in _loaded:
        _loaded["bytes", path] = ByteLevel(path)
    return _loaded["bytes", path]


def pieces(path: str) -> Pieces:
    if ("pieces", path) not in _loaded:
        _loaded["pieces", path] = Pieces(path)
    return _loaded["pieces", path]
