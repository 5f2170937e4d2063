"""Fixed values.

These must equal the values of the workloads this library reproduces, so
that results match; they are stated once, here, in plain form.
"""

# Fixed values of the source workloads (kept as given).
DISCOUNT_FACTOR = "0.9"               # net amount of a discounted order: amount * 0.9
MONTH_FORMAT = "yyyy-MM"              # year_month text
DATE_KEY_FORMAT = "yyyyMMdd"          # integer date key
ACCEPTED_PASSENGERS = [0, 1, 2, 3, 4, 5, 6, 7, 8]
NO_PROMO = "NO_PROMO"                 # promotion member for orders without a code
TOP_N = 10                            # top promo codes; first months of the exam report
HASH_MODULUS = 4                      # hash layout buckets
LIST_REGIONS = ["AMERICA", "EUROPE", "ASIA"]
LOAD_CHUNK_ROWS = 10_000              # capped load: 21 chunks of 10,000 rows
LOAD_CHUNKS = 21
HISTOGRAM_BINS = 50
IQR_WHISKER = 1.5
ZSCORE_LIMIT = 3.0
MINMAX_RANGE = (-1.0, 1.0)
SPLIT_TEST = 0.2                      # 80/20, then 80/20 of the rest: 64/16/20
SPLIT_VALID = 0.16
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_CONTAMINATION = 0.01
GD_RATE = 0.1
GD_EPOCHS = 1000
MINIBATCH_EPOCHS = 50
MINIBATCH_T0 = 200.0
MINIBATCH_T1 = 1000.0
