"""litloom.plans"""
