"""Values that must equal the reference's for the same results."""

# Fixed values (kept together, in the order the operators use them).

TRAJECTORY_SIZE = 500                       # records per trajectory
POSITION_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"  # text time format of position files
DISCOUNT_MIN_QUANTITY = 6                   # discount from this many items on
DISCOUNT_FACTOR = 0.9                       # price factor with the discount
TRUNCATE_WIDTH = 3                          # codes longer than this are cut
TRUNCATE_MARKER = "(trunc)"                 # appended to a cut code
MISSING_CODE = "xxx"                        # stands for a missing code
RESTORED_PREFIX = "restored: "              # prefix of a restored opaque value
WRAP_MARK = "!!"                            # put around each word by the per-row map
PARTITION_TAG_SEPARATOR = " -> "            # between partition number and value
