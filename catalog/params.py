"""Parameters shared by the registered queries and their SQL counterparts."""

# A short list of function words of the test corpora's four languages.
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "on", "that", "for", "by", "with", "as", "at", "are",
    "le", "la", "les", "des", "de", "un", "une", "et", "en", "du", "qui", "que",
    "der", "die", "das", "und", "el", "los", "las", "y",
)

SEARCH_QUERY = "Lytion shst, réaux the ouen"
SEARCH_TERMS = ("lytion", "ouen", "reaux", "shst")

# Keyword rules that hit the invented words of the test corpora.
CORPUS_RULES = {
    "Endings": ("stingly", "edness"),
    "Romance": ("aux", "ción", "é"),
    "Germanic": ("ung", "ich", "ü"),
    "English-like": ("tion", "ing"),
}

ANNOTATION_CATEGORIES = {
    "Coding": ("```", "- "),
    "Creative Writing": ("aux", "the "),
    "Translation": ("ich", "ción"),
}
ANNOTATION_LANGUAGES = {"Python": ("ing",), "SQL": ("est", "ed"), "C++": ("a",)}

CLUSTER_RULES = (
    (("eaux", "aux"), "French-like"),
    (("ing", "est"), "English-like"),
    (("class", "div", "span"), "Web Development (HTML/CSS)"),
)
