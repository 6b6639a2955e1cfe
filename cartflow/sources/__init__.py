"""cartflow.sources"""
