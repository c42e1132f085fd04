"""The parameters of the registered queries."""

import datetime as dt

TERM = "19983"
ON = dt.date(1998, 8, 15)
NEXT_DAY = dt.date(1998, 8, 16)
# the profile's names are dated January 2024
PROFILE_AS_OF = dt.date(2024, 1, 4)
GENDER, TRIBE = "ATTR_GENDER", "ATTR_TRIBE"
TUITION = ("NRES", "RES")
CAREERS = ("GRAD", "PROF", "UGRD")
SPLIT_KEY, SPLITS = "last_name", 12
