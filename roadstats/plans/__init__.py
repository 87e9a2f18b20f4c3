"""Named query plans: the batch tables built from the driver data and the query contract."""
