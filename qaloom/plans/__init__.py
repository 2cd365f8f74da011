"""The three dataset transforms, and their reports."""
