"""cartflow.plans"""
