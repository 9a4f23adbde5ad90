"""Spark-native engine for turning streams of short public documents into routed, linked and auditable records."""
