"""Word lists, patterns and thresholds that decide results."""

# Function words of the gloss languages.
FUNCTION_WORDS = {
    "indonesian": ["yang", "dan", "di", "dengan", "itu", "ini", "tidak", "untuk", "dari", "pada", "adalah", "karena", "juga", "oleh", "dalam"],
    "english": ["the", "of", "and", "in", "to", "is", "was", "that", "it", "he", "his", "as", "for", "on", "with", "are"],
}
# The gloss-language check knows two more English words.
CHECK_WORDS = {"indonesian": FUNCTION_WORDS["indonesian"], "english": [*FUNCTION_WORDS["english"], "this", "from"]}

# Entries.
ENTRY = r"^([A-Za-zÀ-ÿ'’\-]+)\s*(?:\(([a-z.]+)\))?\s*(.+?)\.?\s*$"
CANDIDATE_START = "[A-ZÀ-Ý]"
OVERSIZE = 800
BAD_PAGE = 0.55
MIN_CONTENT = 200

# Page statistics.
PROSE_HINT = r"\b(?:subyek|obyek|subject|object|paradigm|morpheme|affix|suffix|prefix)\b"
NUMBERED = r"\(\d\)"
CROSS_REF = r"\b(?:KS|lht\s+jg|Lit|see\s+also)\s*:"
DOTTED = r"[•·.]{2,}"
PAREN_VARIANT = r"\([a-zà-ÿ]{2,}\)"
POS = ["n", "v", "adj", "adv", "num", "pron", "prep", "conj", "part", "interj"]
SECTION = r"^\s*(?:BAB\s+[IVXLC]+|\d+(?:\.\d+)+\s+\S)"
NUMBERED_ITEM = r"^\s*\d{1,4}\b"
MIN_WORDS, MARKER_FLOOR, SENTENCE_CEILING, SAMPLE = 30, 3, 15, 24

# Conventions, on the first pages of a book.
FIRST_PAGES = 10
CROSS_REFS = {
    "KS": r"\bKS\s*:",
    "lht_jg": r"\blht\s+jg\s*:",
    "cf": r"\b(?:cf|compare)\s*:",
    "see_also": r"\bsee\s+also\s*:",
    "lit": r"\blit\s*:",
}
POS_CODES = [*POS, "m", "f", "pl", "sg"]
ANY_DOTS = r"[•·.]{1,4}"
SENSE = r"(?:^|\s)(\d+)[.)]\s"
AFFIX_HINTS = {
    "meN-": r"\bme[nmblryksw]([a-z]+)",
    "peN-": r"\bpe[nmblryksw]([a-z]+)",
    "-an": r"\b([a-z]+)an\b",
    "me-...-i": r"\bme([a-z]+)i\b",
    "ber-": r"\bber([a-z]+)\b",
}

# Suggested settings: a dotted word to split before, splits at dots and at names, and the parts of an entry pattern.
SPLIT_BEFORE = r"\s+(?=[a-zà-ÿ'’\-]+\s+[•·.]{1,3}\s)"
SPLIT_AT_DOTS = r"(?<=\s)(?=[•·.]{1,4}\s*[a-z])"
SPLIT_AT_NAMES = r"(?<=\s)(?={names})"
ENTRY_DOTS = r"[•·.]{0,4}\s*"
ENTRY_COMPOUND = r"(?:[\s\-]+[a-zà-ÿ''\-]+){0,2}"
ENTRY_SUGGESTED = r"^(?:a\s+)?{dots}(?P<headword>[a-zà-ÿ''\-]+{compound})\s*(?P<gloss>.+)$"

# Correction, flags and patterns.
CONFIDENCE_FLOOR, FIX_PENALTY = 0.75, 0.03
MIN_OCCURRENCES = 3
MAX_PASSES = 5

# Morphology, in the order in which affixes are tried.
PREFIXES = {"meN-": "^me[nmblryksw](.+)$", "peN-": "^pe[nmblryksw](.+)$", "ber-": "^ber(.+)$", "ter-": "^ter(.+)$", "di-": "^di(.+)$"}
SUFFIXES = {"-an": "^(.+)an$", "-i": "^(.+)i$", "-kan": "^(.+)kan$"}
CIRCUMFIXES = {"ke-...-an": "^ke(.+)an$", "peN-...-an": "^pe[nmblryksw](.+)an$"}
REDUPLICATIONS = [r"^([a-z]+)-\1$", r"^([a-z]+)\s+\1$", r"^([a-z]{2,3})\1$"]
MIN_ROOT = 2

# Similarity.
HEADWORD_RATIO, GLOSS_RATIO, SHARED_WORDS, MAX_EXAMPLES = 0.85, 0.90, 2, 10
