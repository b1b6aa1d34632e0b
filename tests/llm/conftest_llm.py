"""What every operator on texts must take: nulls, empty and long texts, repeated rows."""

ODD = [
    (1, None, "a"),
    (2, "", None),
    (None, "no id at all here", "a"),
    (3, "word " * 30_000 + "end", "b"),
    (4, "same text twice in here", "b"),
    (4, "same text twice in here", "b"),
    (5, " \t\n\x0b ", "b"),
    (6, "日本語のテキスト と white", "b"),
    (7, "x" * 5000, "b"),
]
