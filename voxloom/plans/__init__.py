"""voxloom.plans"""
