"""Texts with the awkward cases that every operator has to take."""

LONG = " ".join(f"word{i}x" for i in range(20_000))
TEXTS = [
    "One two three. Four five six seven, eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen.",
    "", None, "   \t\n  ", "single", "two words", LONG, "a b c a b c a b c\na b c\na b c\n\nx",
    "One two three. Four five six seven, eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen.",
    "\u00c9t\u00e9  fran\u00e7ais \u00a0 \u2003 <|endoftext|> don't \U0001f600 \u0301x", "SHOUT!! NOW!! " * 40, "a | b | c | d | e | " * 20,
]
