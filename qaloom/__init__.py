"""A PySpark-native engine that acquires, profiles and searches the documents behind question-answer rows."""
