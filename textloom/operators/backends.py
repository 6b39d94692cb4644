"""Pluggable translation models: a tokenizer and a batch function, made once per Python worker."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable
from functools import lru_cache
from importlib import import_module
from typing import Any

from textloom.functions.merge import merge_fuzzy


class Translator(ABC):
    """A model. ``encode`` gives tokens without an end token, ``count`` counts it."""

    @abstractmethod
    def encode(self, text: str) -> list[Any]: ...

    @abstractmethod
    def decode(self, tokens: list[Any]) -> str: ...

    @abstractmethod
    def translate(self, texts: list[str], max_input_length: int) -> list[str]:
        """A translation a text, of its first ``max_input_length`` tokens."""

    def count(self, text: str) -> int:
        return len(self.encode(text)) + 1 if text else 0

    def windows(self, text: str, limit: int, overlap: int) -> list[str]:
        tokens = self.encode(text)
        ends = len(tokens)
        found, at = [], 0
        while True:
            found.append(self.decode(tokens[at : at + limit]).strip())
            if at + limit >= ends:
                return [w for w in found if w] or [""]
            at += limit - overlap

    def translate_long(self, text: str, limit: int, overlap: int, max_input_length: int) -> tuple[str, int]:
        """The text by windows in one batch, merged again, and how many windows there were."""
        text = text.strip()
        if not text:
            return "", 0
        parts = self.windows(text, limit or 160, overlap)
        done = [t.strip() for t in self.translate(parts, max_input_length)]
        return (merge_fuzzy(done) if overlap else " ".join(t for t in done if t).strip()), len(parts)

    def translate_limited(self, text: str, max_input_length: int, limit: int, overlap: int) -> tuple[str, str, int]:
        """One text at a length limit of its own: (translation, status, windows)."""
        if self.count(text) > max_input_length:
            done, n = self.translate_long(text, limit, overlap, max_input_length)
            return done, "ok_chunked", n
        return self.translate([text], max_input_length)[0], "ok", 0


class EchoTranslator(Translator):
    """The built-in model: words are tokens, and a text is its own translation, spaces tidied."""

    def encode(self, text: str) -> list[str]:
        return text.split()

    def decode(self, tokens: list[str]) -> str:
        return " ".join(tokens)

    def translate(self, texts: list[str], max_input_length: int) -> list[str]:
        return [" ".join(t.split()[:max_input_length]) for t in texts]


class ForgetfulTranslator(EchoTranslator):
    """As echo, but loses placeholders in texts of more than 100 words: what a retry by windows mends."""

    def translate(self, texts: list[str], max_input_length: int) -> list[str]:
        done = super().translate(texts, max_input_length)
        return [t if len(t.split()) <= 100 else " ".join(w for w in t.split() if not (w[:1] == "<" and w[-1:] == ">")) for t in done]


class FragileTranslator(EchoTranslator):
    """As echo, but fails on any call with an e-mail placeholder: what the isolation of failures is for."""

    def translate(self, texts: list[str], max_input_length: int) -> list[str]:
        if any("<EMAIL_ADDRESS>" in t for t in texts):
            raise RuntimeError("unknown placeholder")
        return super().translate(texts, max_input_length)


class MarianTranslator(Translator):
    """A sequence-to-sequence model of the transformers library, if that is installed."""

    def __init__(self, model_name: str, device: str = "cpu", max_new_tokens: int = 512, num_beams: int = 1):
        import torch
        from transformers import AutoModelForSeq2SeqLM, AutoTokenizer

        self.torch, self.options = torch, {"max_new_tokens": max_new_tokens, "num_beams": num_beams}
        self.device = device if device != "cuda" or torch.cuda.is_available() else "cpu"
        self.tokenizer = AutoTokenizer.from_pretrained(model_name)
        self.model = AutoModelForSeq2SeqLM.from_pretrained(model_name).to(self.device).eval()

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False)

    def decode(self, tokens: list[int]) -> str:
        return self.tokenizer.decode(tokens, skip_special_tokens=True)

    def translate(self, texts: list[str], max_input_length: int) -> list[str]:
        if not texts:
            return []
        batch = self.tokenizer(texts, return_tensors="pt", padding=True, truncation=True, max_length=max_input_length).to(self.device)
        with self.torch.no_grad():
            out = self.model.generate(**batch, **self.options)
        return self.tokenizer.batch_decode(out, skip_special_tokens=True)


_MAKERS: dict[str, Callable[..., Translator]] = {"echo": lambda **_: EchoTranslator(), "forgetful": lambda **_: ForgetfulTranslator(), "fragile": lambda **_: FragileTranslator()}


@lru_cache(4)
def translator(name: str, device: str = "cpu", max_new_tokens: int = 512, num_beams: int = 1) -> Translator:
    """A built-in model, one that ``module:attribute`` makes (workers import it), or one of the transformers library."""
    options = {"device": device, "max_new_tokens": max_new_tokens, "num_beams": num_beams}
    if name in _MAKERS:
        return _MAKERS[name](**options)
    if ":" in name:
        module, _, attribute = name.partition(":")
        return getattr(import_module(module), attribute)(**options)
    return MarianTranslator(name, device, max_new_tokens, num_beams)
