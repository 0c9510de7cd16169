"""Fixed values.

Everything in this file must have exactly these values for results to be right:
word lists, the spelling table, patterns and published settings.
"""

# Whole-word spelling corrections, applied in this order.
SPELLING = {
    "hapy": "happy",
    "angy": "angry",
    "luv": "love",
    "amzing": "amazing",
    "terible": "terrible",
    "excelent": "excellent",
    "performnce": "performance",
    "gud": "good",
    "vry": "very",
    "fantstic": "fantastic",
    "gr8": "great",
    "horrble": "horrible",
    "im": "i am",
    "omg": "oh my god",
    "plz": "please",
    "thx": "thanks",
}

# Stop words removed before n-grams are built for TF-IDF features.
STOP_WORDS = [
    "the", "and", "is", "in", "it", "to", "of", "that", "this",
    "a", "for", "on", "with", "as", "at", "by", "an", "be", "or", "from",
    "just",
]

# ASCII punctuation except the apostrophe.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

# Field contents that a CSV reader takes for "missing".
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Masks and literals.
MASK = "X"
URL_MASK = "http"
MISSING_TEXT = "nan"

# Special entries of a subword vocabulary.
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
CONTINUATION = "##"
MAX_WORD_CHARS = 100

# Published settings.
MAX_LEN = 128
BATCH_SIZE = 64
TRAIN_BATCH_SIZE = 128
HIST_BINS = 50
KDE_POINTS = 200
TFIDF_NGRAMS = (1, 3)
TFIDF_MAX_FEATURES = 25000
TFIDF_MIN_DF = 2
PROFILE_NGRAMS = (1, 2)
PROFILE_MAX_FEATURES = 2000
TOP_N = 20
LOGISTIC_C = 2.0
LOGISTIC_MAX_ITER = 500
MLP_HIDDEN = [500, 201, 65]
MLP_EPOCHS = 30
SEED = 10
FOLDS = 5
CURVE_STEPS = 10
TRAIN_SUBSET, VAL_SUBSET = 0.05, 0.03
