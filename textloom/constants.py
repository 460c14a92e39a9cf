"""Fixed values that must equal the behaviour being reproduced.

FIXED VALUES (special tokens and ids, pads, caps):
  special tokens in id order: "<pad>" -> 0, "<|endoftext|>" -> 1, "<EMAIL>" -> 2, "<PHONE>" -> 3
  label pad -100, input/mask pad 0
  default sequence cap 1024, default vocabulary size 25000
  length gate: keep 10 <= length <= 20000 (measured before stripping)
  packing group size 1000 rows
"""

PAD_TOKEN = "<pad>"
END_OF_TEXT_TOKEN = "<|endoftext|>"
SPECIAL_TOKENS = ["<pad>", "<|endoftext|>", "<EMAIL>", "<PHONE>"]
PAD_ID = 0
EOD_ID = 1
LABEL_PAD_ID = -100

DEFAULT_SEQUENCE_LENGTH = 1024
DEFAULT_VOCAB_SIZE = 25000
MIN_DOC_CHARS = 10
MAX_DOC_CHARS = 20000
PACK_GROUP_ROWS = 1000

# Characters Python's str.strip() removes: the Unicode White_Space set plus the
# four information separators U+001C..U+001F.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# CJK ideograph ranges (inclusive code points) used by the "is Chinese char" test.
CJK_RANGES = [
    (0x4E00, 0x9FFF),
    (0x3400, 0x4DBF),
    (0x20000, 0x2A6DF),
    (0x2A700, 0x2B73F),
    (0x2B740, 0x2B81F),
    (0x2B820, 0x2CEAF),
    (0xF900, 0xFAFF),
    (0x2F800, 0x2FA1F),
]

# GPT-2 style pre-tokenisation pattern (Java regex; (?U) makes \s Unicode aware).
PRETOKEN_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
