"""litloom.functions"""
