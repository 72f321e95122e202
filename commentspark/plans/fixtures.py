"""Small constant inputs (parameters) used by the registered queries.

They are parameters, not data: every query still reads the driver tables
(documents, embeddings, labels, conversations, events) and its work grows
with them.
"""

from __future__ import annotations

# --- fixed values: lexical/dense evaluation query set ----------------------------
# (id, query text, expected keywords, expected topic ids, dense query vec_id)
EVAL_QUERIES = [
    ("q1", "thtion attion eriner", ["thtion", "attion", "zzzz"], [0, 1, 2], 0),
    ("q2", "the licensed apache", ["licensed", "Apache", "GNU"], [], 1),
    ("q3", "ontion ontion retion", ["ontion", "retion"], [3], 2),
    ("q4", "und ention", ["und", "ention"], [4, 5], 3),
    ("q5", "zzzz", ["zzzz"], [9], 4),
]

# --- fixed values: lexicon A (polarity, subjectivity) ----------------------------
LEXICON_A = {
    "thtion": (0.6, 0.8),
    "attion": (0.4, 0.5),
    "ontion": (0.2, 0.3),
    "ertion": (-0.5, 0.7),
    "eriner": (-0.4, 0.6),
    "retion": (-0.2, 0.2),
}

# --- fixed values: lexicon B (valence, second rater) -----------------------------
LEXICON_B = {
    "thtion": 2.0,
    "attion": 1.0,
    "antion": 1.5,
    "ertion": -2.0,
    "ention": -1.5,
    "retion": -1.0,
}

# --- fixed values: entity patterns (label, regex, group) -------------------------
ENTITY_PATTERNS = [
    ("EMAIL", r"[\w.+-]+@[\w-]+\.[\w.]+", 0),
    ("IP", r"\b\d+\.\d+\.\d+\.\d+\b", 0),
    ("LICENSE", r"Licensed under [^\n.]+", 0),
    ("PERSON", r"(?:^|[^\p{L}\p{N}_])([A-Z][a-z]+ [A-Z][a-z]+)(?:$|[^\p{L}\p{N}_])", 1),
]

# --- fixed values: router questions, one per branch -------------------------------
ROUTER_QUESTIONS = [
    ("r1", "Summarize negative sentiment"),
    ("r2", "Which product is mentioned?"),
    ("r3", "What about topic 3?"),
    ("r4", "Show pain points"),
]
