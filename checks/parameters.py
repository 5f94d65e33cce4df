"""Parameters shared by the registered queries and their SQL twins."""

from datetime import date, datetime

# The moment and the experiment window that fit the event data.
AS_OF = "2024-01-30 23:07:00"
# A run whose newest points alert, and days that the stream check counts anew.
ALERT_AS_OF = "2024-01-30 15:50:00"
REPAIRED = (date(2024, 1, 28), date(2024, 1, 29))
# First day of the data; days from which the second run of an incremental job adds, and which it finds replaced.
MONTH, HALF, LATE = date(2024, 1, 1), date(2024, 1, 15), date(2024, 1, 10)
START, END = datetime(2024, 1, 8), datetime(2024, 1, 14)
# A day inside the experiment with which a second run begins; a user.
SPLIT = datetime(2024, 1, 11)
USER = 11
SEED = 20220613
REPLICATES = 1000
# So few that the rank test is exact.
FEW_BUCKETS = 6
DIGITS = 6
