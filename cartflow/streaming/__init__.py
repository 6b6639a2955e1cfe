"""cartflow.streaming"""
