"""Default parameters of the proposal (see README)."""

import datetime as _dt

# The cutoff, label horizon and event vocabulary of the
# driver's ``events`` table.
CUTOFF = _dt.datetime(2024, 1, 21)
HORIZON_DAYS = 3
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
TARGET_TYPE = "purchase"
HORIZONS = (1, 3, 7, 14)
SESSION_GAP_MINUTES = 30
ROLLING_DAYS = 7
TOP_K = 3
N_FOLDS = 5
CLIP_P = 0.01
THRESHOLD = 0.2
MONEY_SCALE = 2    # decimal places of the fixture's values
