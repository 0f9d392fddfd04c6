"""Team-sport schedule and betting-line analytics as plain PySpark DataFrame operators."""
