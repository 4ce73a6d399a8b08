"""The row-wise part of the work on a stream of arriving documents."""
