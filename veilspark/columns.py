"""Column groups that every table of a study shares."""

STUDY = ("ask_id", "rshp_id")
STUDY_PROVIDER = (*STUDY, "prvdr_cd")
DATASET = (*STUDY_PROVIDER, "cat_cd")

IDENTITY = ("mrg_nm", "mrg_ssn")
PERSON = (*STUDY_PROVIDER, *IDENTITY)
KEY = (*STUDY_PROVIDER, "hash_did")
HASHED_PERSON = (*PERSON, "ttp_id", "hash_did")
DATA_META = (*KEY, "cat_cd")

# Status codes of executions and of their detail rows (fixed values).
OK = "002"
WARNING = "003"
FAILED = "902"
