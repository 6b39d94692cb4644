"""Models for tests, made on the workers by name."""

from textloom.operators.backends import EchoTranslator


class Failing(EchoTranslator):
    """Fails on any batch with the word FAIL, and loses placeholders unless a text stands alone."""

    def __init__(self, **_):
        pass

    def translate(self, texts, max_input_length):
        if any("FAIL" in t for t in texts):
            raise RuntimeError("model broke")
        if any("NEVER" in t for t in texts) and len(texts) == 1:
            raise RuntimeError("broke again")
        done = super().translate(texts, max_input_length)
        return done if len(texts) == 1 else [t.replace("<A>", "") for t in done]


def scorer(model_name):
    if model_name == "missing":
        raise OSError("no such model")

    def score(pairs):
        if any("BAD" in a for a, _ in pairs):
            raise ValueError("bad pair")
        return [min(1.0, len(b) / 10) for _, b in pairs]

    return score
