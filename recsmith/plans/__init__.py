"""recsmith.plans"""
