"""Fixed values.

Results only match existing question banks when these words, patterns and
numbers are exactly the agreed ones, so they are stated once, as plain text.
"""

# --- fixed values: answer line -------------------------------------------------
ANSWER_MARKER = "答案[：:]"
ANSWER_LABEL = "答案："
FALLBACK_ANSWER = "0"

# --- fixed values: number patterns ---------------------------------------------
SIGNED_NUMBER = r"-?\d+\.?\d*"
UNSIGNED_NUMBER = r"\d+(?:\.\d+)?"
INTEGER = r"\d+"

# --- fixed values: equation classes, in the order they are looked at -----------
EQUATION_CLASSES = (
    ("multiply", "[×x*]"),
    ("add_subtract", "[+-]"),
    ("divide", "/"),
)

# --- fixed values: words that show worked steps --------------------------------
STEP_WORDS = ("步骤", "先", "再", "然后", "因此", "所以")

# --- fixed values: rewards, advantages, clipped loss ---------------------------
REWARD_CORRECT = 1.0
REWARD_FORMAT = 0.1
NUMBER_TOLERANCE = 0.01
ADVANTAGE_EPSILON = 1e-6
CLIP_EPSILON = 0.2
KL_COEFFICIENT = 0.04
TRAILING_STEPS = 20

# --- fixed values: number substitution -----------------------------------------
SUBSTITUTED_NUMBERS = 2
FACTOR_LOW = 0.5
FACTOR_HIGH = 2.0

# --- fixed values: chat mark-up (ChatML) and label mask ------------------------
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"
IGNORED_LABEL = -100

# --- fixed values: score of a finished entry -----------------------------------
SCORE_FULL_MARKS = 15.0
WORK_POINTS_SOLO = 5.0
WORK_POINTS_TEAM = 3.0

# --- fixed values: sampling and retries ----------------------------------------
DEFAULT_SEED = 42
EVALUATION_SAMPLE = 400
GENERATION_TRIES = 3
RETRY_WAIT_SECONDS = 2.0
CALL_INTERVAL_SECONDS = 0.3

# White space and its complement as Python's str methods see it; to be used
# under the (?U) flag, where \s alone misses the four separator controls.
SPACE = r"[\s\x1c-\x1f]"
NON_SPACE = r"[^\s\x1c-\x1f]"
