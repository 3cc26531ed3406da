"""Regular expressions of the cleaning functions (Java dialect, RE2-safe
except ``NON_PRINTABLE``, which needs class intersection)."""

# Personal-data patterns in the order they run, with the token
# that replaces a hit. All are matched without regard to case.
PERSONAL_DATA = (
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL]"),
    (
        "phone",
        r"\b(?:\+?1[-.]?)?\(?([0-9]{3})\)?[-.]?([0-9]{3})[-.]?([0-9]{4})\b",
        "[PHONE]",
    ),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]"),
    ("credit_card", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", "[CARD]"),
    ("ip_address", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "[IP_ADDRESS]"),
    (
        "url",
        r"https?://(?:www\.)?[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b"
        r"(?:[-a-zA-Z0-9()@:%_\+.~#?&/=]*)",
        "[URL]",
    ),
    ("ticket_id", r"\b(?:ticket|id|case)[\s#:]*[A-Z0-9]{6,}\b", "[TICKET_ID]"),
    ("invoice_id", r"\b(?:invoice|inv)[\s#:]*[A-Z0-9]{6,}\b", "[INVOICE_ID]"),
    ("user_id", r"\b(?:user|uid)[\s#:]*[A-Z0-9]{6,}\b", "[USER_ID]"),
    ("account_number", r"\b(?:account|acct)[\s#:]*\d{6,}\b", "[ACCOUNT_NUMBER]"),
)

# Page artefacts and what replaces them, in order. Escaped angle
# brackets are decoded before tags go, so escaped tags go too.
MARKUP = (
    (r"\r\n|\r|\n", " "),
    (r"\t", " "),
    (r"&nbsp;", " "),
    (r"&amp;", "&"),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#\d+;", ""),
    (r"<[^>]+>", ""),
)

# Runs of punctuation and what replaces them, in order.
NOISE = (
    (r"\.{3,}", "..."),
    (r"!{2,}", "!"),
    (r"\?{2,}", "?"),
    (r"-{3,}", " "),
    (r"={3,}", " "),
    (r"_{3,}", " "),
)

# The shortest run that each of these patterns finds.
NOISE_RUNS = {
    r"\.{3,}": "...",
    r"!{2,}": "!!",
    r"\?{2,}": "??",
    r"-{3,}": "---",
    r"={3,}": "===",
    r"_{3,}": "___",
}

# Whitespace as a Unicode-aware string split sees it; ``\s`` alone is ASCII.
NARROW_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
WIDE_SPACES = "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
WHITESPACE = f"[{NARROW_SPACES}{WIDE_SPACES}]"
NOT_WHITESPACE = f"[^{NARROW_SPACES}{WIDE_SPACES}]"

# Control, format, surrogate, private and unassigned characters, but for the
# control characters that count as whitespace.
NON_PRINTABLE = r"[\p{C}&&[^\t-\r\x{1c}-\x{1f}\x{85}]]"
