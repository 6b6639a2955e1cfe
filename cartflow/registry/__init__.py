"""cartflow.registry"""
