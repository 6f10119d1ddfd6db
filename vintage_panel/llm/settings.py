"""Paths outside the repository."""

from __future__ import annotations

import os

#: vocabulary file of a public byte-pair SentencePiece model
PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
