"""Point-in-time customer features, inactivity labels and model monitoring on Spark."""
