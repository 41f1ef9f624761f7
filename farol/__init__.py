"""farol: early-warning analytics for education programmes, written for Spark."""
