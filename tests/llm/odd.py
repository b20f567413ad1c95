"""Documents that every text operator must take."""

#: Texts that every text operator must take: null, empty, blank, short, long, ties.
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "one two", "x  y   z", " lead", "trail ", "tab\tseparated\x0bwords", "a \n \n b",
    "line one.\nline two.\n\nline three", "É̀ ǅ Σας İstanbul ﬁ", "日本語 テキスト 。", "<|endoftext|>", "a<|endoftext|> b", "it's we're 'S",
    " nbsp  here 　", "12 345 6.7", "zzz " * 400, "long" * 5000, "emoji 😀 a👍b", "\x1c\x1d odd", "...,,, ., a., b,.", "word.\nNext,",
]


def odd_rows():
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    return rows + [(3, "again three"), (3, "again three"), (None, "no id at all"), (None, None)]
