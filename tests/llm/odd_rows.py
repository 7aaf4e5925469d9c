"""Inputs that every operator has to stand."""

#: Texts with every shape the operators have to stand: null, empty, white space, one word, repeats, long.
ODD_TEXTS = [
    None, "", " \n\t\n ", "one", "One two", "A line that is shared\nshort\nA line that is shared",
    "  a LINE that is shared \nand another line here", "a line that is shared",
    "ünïcödé wörds hêre, ñandú", "x" * 5_000, " ".join(f"w{i}" for i in range(3_000)),
    " ".join(f"w{i}" for i in range(3_000)), "!!! ### $$$", "▁mark ▁", "日本 語 テキスト 中文 字",
]

ODD_ROWS = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a line that is shared"), (None, None),
                                                       (3, "one"), (7, "another text for an id that is taken")]

#: Column names that the operators use themselves.
CLASHES = ("row", "id", "key", "keys", "n", "h", "component", "block", "spans", "score", "w", "label", "rid", "length")
