"""A package, so that its modules may share names with those of tests/."""
