"""Rows that every operator must bear."""

ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. It runs, and runs, and runs away from the big red barn at noon."),
    (2, "The quick brown fox jumps over the lazy dog. It runs, and runs, and runs away from the big red barn at noon."),
    (2, "The quick brown fox jumps over the lazy dog. It runs, and runs, and runs away from the big red barn at noon."),
    (3, None),
    (4, ""),
    (None, "a row without an id, and some more words to fill the line of it"),
    (5, " \n\t \n"),
    (6, "12345 67890 !!! ???"),
    (7, "word " * 30_000),
    (8, "x" * 60_000),
    (9, "Ünïcödé wörter, naïve façade; 日本語のテキスト 🙂 — done"),
    (2, "another text under an id that is taken"),
]
