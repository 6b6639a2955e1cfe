"""cartflow.operators"""
