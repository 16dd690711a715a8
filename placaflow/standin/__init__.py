"""Source tables derived from the test data set (TPC-H-like), and their SQL twins."""
