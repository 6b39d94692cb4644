"""Settings of a translation run: given values before environment before defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import MISSING, dataclass, fields
from typing import Any

from textloom.functions.text import SWITCH_OFF, SWITCH_ON


def parse_bool(value: str | bool) -> bool:
    """A switch from its usual spellings, in any case."""
    if isinstance(value, bool):
        return value
    low = value.strip().lower()
    if low not in SWITCH_ON + SWITCH_OFF:
        raise ValueError(f"not a yes or no: {value!r}")
    return low in SWITCH_ON


@dataclass(frozen=True)
class Config:
    input_path: str = "data/input/input.csv"
    output_path: str = "data/output/output.csv"
    model_name: str | None = None
    device: str = "cpu"
    log_level: str = "INFO"
    log_file: str | None = None
    report_path: str | None = None
    progress_path: str | None = None
    limit: int | None = None
    source_lang: str | None = None
    target_lang: str | None = None
    text_column: str = "message"
    label_column: str = "label"
    batch_size: int = 16
    batch_token_budget: int = 4096
    input_chunk_size: int = 5000
    max_input_length: int = 256
    chunk_token_limit: int = 160
    chunk_overlap_tokens: int = 0
    max_new_tokens: int = 512
    num_beams: int = 1
    max_translate_tokens: int | None = 1024
    checkpoint_interval: int = 50
    skip_url_like: bool = True
    sort_batches_by_length: bool = False
    retry_placeholder_mismatch: bool = True
    enable_qe: bool = False
    qe_backend: str | None = None
    qe_model_name: str | None = None
    qe_high_threshold: float = 0.7
    qe_medium_threshold: float = 0.4

    @classmethod
    def load(cls, given: Mapping[str, Any] | None = None, environment: Mapping[str, str] | None = None) -> Config:
        """Values that are given (None: not given), else the environment's upper-case names, else defaults."""
        given, environment = given or {}, os.environ if environment is None else environment
        unknown = set(given) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        found: dict[str, Any] = {}
        for f in fields(cls):
            value = given.get(f.name)
            if value is None:
                value = environment.get(f.name.upper()) or None
            if value is None:
                found[f.name] = None if f.default is MISSING else f.default
            elif "bool" in f.type:
                found[f.name] = parse_bool(value)
            else:
                found[f.name] = int(value) if f.type.startswith("int") else float(value) if f.type.startswith("float") else str(value)
        return cls(**found)

    def validate(self, need_model: bool = True) -> Config:
        """Self, or a ValueError that says what is wrong."""
        if need_model and not self.model_name:
            raise ValueError("a model name is required")
        positive = "batch_size batch_token_budget input_chunk_size max_input_length chunk_token_limit max_new_tokens num_beams checkpoint_interval".split()
        for name in [*positive, *(n for n in ("limit", "max_translate_tokens") if getattr(self, n) is not None)]:
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be greater than 0")
        if self.device not in ("cpu", "cuda"):
            raise ValueError(f"unknown device {self.device!r}")
        if self.log_level.upper() not in ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"):
            raise ValueError(f"unknown log level {self.log_level!r}")
        if self.chunk_token_limit > self.max_input_length:
            raise ValueError("chunk_token_limit must not exceed max_input_length")
        if not 0 <= self.chunk_overlap_tokens < self.chunk_token_limit:
            raise ValueError("chunk_overlap_tokens must be at least 0 and less than chunk_token_limit")
        if self.enable_qe:
            from textloom.operators.qe import check_backend

            check_backend(self.qe_backend, self.qe_model_name)
            if not 0 <= self.qe_medium_threshold <= self.qe_high_threshold:
                raise ValueError("thresholds must satisfy 0 <= medium <= high")
        return self
