"""Settings of the toolkit, in one frozen record."""

from __future__ import annotations

from dataclasses import dataclass


# The numbering of the four special tokens.
PAD, UNK, START, END = 0, 1, 2, 3
SPECIAL_TOKENS = ("<PAD>", "<UNK>", "<START>", "<END>")

# Column names of the pair table.
TEXT, SUMMARY = "texto", "resumen"


@dataclass(frozen=True)
class Settings:
    """Defaults used by the operators; pass your own values as arguments."""

    # Lengths and vocabulary sizes.
    max_text_length: int = 500
    max_summary_length: int = 100
    text_vocabulary: int = 50_000
    summary_vocabulary: int = 20_000
    sentences_to_extract: int = 5
    score_threshold: float = 0.5
    beam_width: int = 5
    seed: int = 42
    train_fraction: float = 0.8
    fallback_validation_fraction: float = 0.2
    min_words: int = 10
    min_pairs: int = 10
    histogram_bins: int = 30
    top_words: int = 20

    # Spark side: a lookup table is broadcast only up to these measured sizes.
    broadcast_rows: int = 2_000_000
    broadcast_bytes: int = 64 * 1024 * 1024
    # Beyond them only this many of the most frequent keys are broadcast, cut to
    # the same number of bytes, so that the broadcast has a proven size.
    hot_rows: int = 10_000
    # The share that a text's own successors have in decoding.
    text_share: float = 0.5
    special_tokens: tuple[str, ...] = SPECIAL_TOKENS


DEFAULTS = Settings()
