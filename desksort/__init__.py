"""Support-ticket preparation, classification and evaluation on Spark."""
