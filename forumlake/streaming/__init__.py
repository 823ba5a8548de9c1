"""Incremental forms of the batch jobs. Each takes a checkpoint folder and runs until the input is used up."""
