"""Texts for tests."""


def prose(rng, words, vocabulary=400):
    """Invented sentences."""
    names = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    out = [rng.choice(names) for _ in range(words)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(out)) + "."
