"""Spark jobs for software-delivery and assistant-usage data landed as API answers."""
