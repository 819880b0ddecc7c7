"""Lists, patterns and defaults that results depend on."""

# --- Fixed values: passenger features -------------------------------------
TITLE_PATTERN = r",\s*([^\.]+)\."
RARE_TITLES = [
    "Lady", "Countess", "Capt", "Col", "Don", "Dr", "Major", "Rev",
    "Sir", "Jonkheer", "Dona",
]
TITLE_SYNONYMS = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
UNKNOWN_DECK = "Unknown"
NUMERIC_FEATURES = ["Age", "Fare", "FamilySize", "SibSp", "Parch", "IsAlone", "HasCabin"]
CATEGORICAL_FEATURES = ["Pclass", "Sex", "Embarked", "Title", "Deck"]
OUTCOME_NAMES = {0: "Died", 1: "Survived"}

# --- Fixed values: scoring request defaults -------------------------------
REQUEST_DEFAULTS = {
    "Pclass": 3,
    "Sex": "male",
    "Age": 30.0,
    "SibSp": 0,
    "Parch": 0,
    "Fare": 32.0,
    "Embarked": "S",
    "Title": "Mr",
    "Deck": "Unknown",
}

# --- Fixed values: fingerspelling -----------------------------------------
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOTION_LETTERS = ["J", "Z"]
IMAGE_SIDE = 28
LABEL_CLASSES = 25
UNKNOWN_LETTER = "?"
UNKNOWN_LABEL = -1
SPACE_LABELS = ["space", "blank"]
NO_LETTER_LABELS = ["del", "delete", "nothing", "none"]
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "bmp"]
HAND_POINTS = 21
WRIST = 0
MIDDLE_KNUCKLE = 9

# --- Fixed values: defaults of training and the live committer ------------
SEED = 42
FOLDS = 5
TEST_FRACTION = 0.15
MIN_TRAINING_ROWS = 50
JITTER_COPIES = 4
JITTER_SIGMA = 0.008
STABLE_FRAMES = 12
MIN_CONFIDENCE = 0.70
LIVE_STABLE_FRAMES = 4
LIVE_MIN_CONFIDENCE = 0.50
GAP_SECONDS = 1.2

# Texts that stand for a missing value in a table file
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Settings of the compared models
FOREST_TREES, FOREST_DEPTH, FOREST_LEAF = 400, 6, 2
BOOST_ROUNDS, BOOST_STEP, BOOST_DEPTH = 300, 0.05, 3
PERCEPTRON_HIDDEN, PERCEPTRON_ITERATIONS = [256, 128], 600
