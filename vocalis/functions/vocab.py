"""Vocabularies and lookup rows.

FIXED VALUES: the strings, codes, patterns and numbers below must equal the
ones the reference pipeline uses, otherwise labels and features differ.
They are stated plainly, in their natural order.
"""

# ---- FIXED VALUES: corpus tags (substring in path -> corpus name), first match wins
CORPUS_TAGS = [
    ("Ravdess", "RAVDESS"),
    ("Crema", "CREMA"),
    ("Tess", "TESS"),
    ("Savee", "SAVEE"),
]

# ---- FIXED VALUES: emotion-code pattern per corpus (regex, group), applied to the whole path
CODE_PATTERNS = {
    "RAVDESS": (r"(\d{2})-(\d{2})-(\d{2})-", 3),
    "CREMA": (r"_([A-Z]{3})_([A-Z]+)\.wav", 1),
    "TESS": (r"_([a-z]+)\.wav", 1),
    "SAVEE": (r"([a-z]+)\d{2}\.wav", 1),
}

# ---- FIXED VALUES: code -> label (batch pipeline, 7 labels; RAVDESS 02 "calm" folds into neutral)
LABEL_CODES = {
    "happy": ["03", "HAP", "happy", "h"],
    "sad": ["04", "SAD", "sad", "sa"],
    "angry": ["05", "ANG", "angry", "a"],
    "fear": ["06", "FEA", "fear", "f"],
    "disgust": ["07", "DIS", "disgust", "d"],
    "surprise": ["08", "ps", "su", "surprise"],
    "neutral": ["01", "02", "NEU", "neutral", "n"],
}

# ---- FIXED VALUES: the 7-label batch vocabulary, sorted (= encoder order)
EMOTIONS_7 = ["angry", "disgust", "fear", "happy", "neutral", "sad", "surprise"]

# ---- FIXED VALUES: the 8-label serving vocabulary (keeps TESS "ps")
EMOTIONS_8 = ["angry", "disgust", "fear", "happy", "neutral", "ps", "sad", "surprise"]

# ---- FIXED VALUES: display rows (label, French text, emoji); default is (title case, "❓")
DISPLAY = [
    ("angry", "Colère", "😡"),
    ("disgust", "Dégoût", "🤢"),
    ("fear", "Peur", "😨"),
    ("happy", "Joie", "😄"),
    ("neutral", "Neutre", "😐"),
    ("ps", "Surprise+", "😮"),
    ("sad", "Tristesse", "😢"),
    ("surprise", "Surprise", "😲"),
]
DISPLAY_DEFAULT_EMOJI = "❓"

# ---- FIXED VALUES: filename-only parser (serving side)
FN_RAVDESS_PREFIX = "03-01"
FN_RAVDESS_MIN_DASHES = 5
FN_RAVDESS = {
    "01": "neutral", "02": "neutral", "03": "happy", "04": "sad",
    "05": "angry", "06": "fear", "07": "disgust", "08": "surprise",
}
FN_TESS_WORDS = ["angry", "disgust", "fear", "happy", "neutral", "sad", "surprise", "ps"]
FN_CREMA = {"ANG": "angry", "DIS": "disgust", "FEA": "fear", "HAP": "happy", "NEU": "neutral", "SAD": "sad"}
FN_SAVEE = {"a": "angry", "d": "disgust", "f": "fear", "h": "happy", "n": "neutral", "sa": "sad", "su": "surprise"}
UNKNOWN = "unknown"

# ---- FIXED VALUES: augmentation tags, in write order
AUGMENTATIONS = ["original", "pitch_shift", "white_noise", "time_stretch"]
NOISE_FACTOR = 0.005
PITCH_STEPS = 4
STRETCH_RATE = 1.2

# ---- FIXED VALUES: signal parameters
SAMPLE_RATE = 22050
N_FFT = 2048
HOP = 512
N_MFCC = 40
N_MELS = 128
N_CHROMA = 12
ROLL_PERCENT = 0.85
TOP_DB = 80.0
AMIN = 1e-10
ZCR_THRESHOLD = 1e-10
FEATURE_DIM = 185
TRAIN_PERCENT = 80


def code_label_rows():
    """(code, label) rows of the 29-entry lookup."""
    return [(code, label) for label, codes in LABEL_CODES.items() for code in codes]
