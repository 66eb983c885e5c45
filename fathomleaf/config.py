"""Knobs of the engine."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    chunk_size: int = 2000  # tokens
    chunk_overlap: int = 400
    chars_per_token: int = 4  # for windows without a tokenizer
    max_chunks_per_group: int = 3
    section_window: int = 3
    section_passes: int = 1
    deep_fields_per_facility: int = 20
    detection_budget: int = 5000
    prompt_budget: int = 6500
    verification_budget: int = 4000
    deep_budget: int = 6000
    retriever: str = "bm25"  # or "embedding", "hybrid"
    hybrid_bm25_weight: float = 0.5
    k1: float = 1.5
    b: float = 0.75
    max_expansion: int = 3
    ocr_below_chars: int = 100
    dpi: int = 300
    max_new_tokens: int = 1024
    embedding_batch: int = 32
    embedding_max_length: int = 2048

    def __post_init__(self) -> None:
        if not 0 <= self.chunk_overlap < self.chunk_size:
            raise ValueError("chunk_overlap must be at least 0 and below chunk_size")
        if self.retriever not in ("bm25", "embedding", "hybrid"):
            raise ValueError(f"unknown retriever: {self.retriever}")
