"""Default parameters.

Fixed values that must equal the reference's for equal results
(filter parameters, split fractions, model switch points, batch-size rule):

    savitzky_golay: window 11, polyorder 3
    moving_average: window 5
    gaussian: sigma 2, truncate 4.0 (radius = int(4 * sigma + 0.5))
    median: kernel_size 5
    kalman: process_variance 1e-5, measurement_variance 0.1
    filters compared, in run order: none, savitzky_golay, moving_average,
        gaussian, median, kalman
    sequence length 50
    test_size 0.3, validation_split 0.5
    model switch: more than 5000 train rows -> linear_regression,
        more than 1000 -> svr, otherwise random_forest
    random forest: 100 trees, depth 10, seed 42
    svr: rbf kernel, C 1.0, epsilon 0.1
    mlp: hidden layers (100, 50), max_iter 1000, seed 42
    batch size: 16 <= power of two <= clamp(n / 10, 16, 256), then at most 64
    within-percent thresholds: 5 and 10 percent, denominator floor 1e-10
    unmasked MAPE denominator floor: 2.220446049250313e-16 (float64 eps)
    early stop patience 10, learning-rate patience 5, factor 0.5, floor 1e-6
"""

SG_WINDOW = 11
SG_POLYORDER = 3
MA_WINDOW = 5
GAUSSIAN_SIGMA = 2.0
GAUSSIAN_TRUNCATE = 4.0
MEDIAN_KERNEL_SIZE = 5
KALMAN_PROCESS_VARIANCE = 1e-5
KALMAN_MEASUREMENT_VARIANCE = 0.1

FILTERS_TO_COMPARE = (
    "none",
    "savitzky_golay",
    "moving_average",
    "gaussian",
    "median",
    "kalman",
)

SEQUENCE_LENGTH = 50
TEST_SIZE = 0.3
VALIDATION_SPLIT = 0.5

LINEAR_ABOVE_ROWS = 5000
SVR_ABOVE_ROWS = 1000

FOREST_TREES = 100
FOREST_DEPTH = 10
SEED = 42

SVR_C = 1.0
SVR_EPSILON = 0.1
MLP_HIDDEN = (100, 50)
MLP_MAX_ITER = 1000

BATCH_SIZE_CAP = 64
BATCH_MIN = 16
BATCH_MAX = 256

WITHIN_FLOOR = 1e-10
MAPE_EPS = 2.220446049250313e-16

EARLY_STOP_PATIENCE = 10
LR_PATIENCE = 5
LR_FACTOR = 0.5
LR_FLOOR = 1e-6
